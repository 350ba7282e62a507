"""Main text of web pages by site style trees.

The pages of a host are merged: a node of the site's style tree is an element path (tags with their classes), and has
one presentation style and one content per page.  A node's importance is the entropy of these over the m pages that
have it, to the base m: 0 if all pages show the same, 1 if each shows something else,

    importance = CONTENT * H(contents) + (1 - CONTENT) * H(styles).

Branches of low importance are removed from each page, besides those whose tag, role or class says that they are no
text of the page (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments).  Where a page marks
its article, only the article is read.  Plain paragraphs and headings of an article are its text whatever their
importance, so pages that copy each other stay whole.

The tree of a host is never gathered: it is counts by (host, path, content), folded before each shuffle.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.llm.common import col, fresh, map_arrow, stored

#: Weight of the contents' entropy against the styles'; importance below which a branch goes; pages a node needs.
CONTENT, LEAST, PAGES = 0.9, 0.2, 5

#: Elements that are read over, with all in them.
SKIPPED = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video map select datalist button input textarea form nav menu aside footer dialog".split()
)
#: Read over outside an article.
SKIPPED_OUTSIDE = frozenset(["header"])
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Class and id names, or their first or last part, of branches that are no text of the page.
SKIPPED_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts advertisement sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended pagination pager "
    "comment comments replies disqus widget skip toolbar legal copyright".split()
)
NEVER_SKIPPED = frozenset(["html", "body", "article", "main"])
RAW = frozenset(["script", "style", "textarea", "title", "iframe", "noscript", "template"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: What an opening tag closes if it is open: paragraphs, and items of its own kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre article main section body td th dd dt figcaption".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PART = re.compile(r"[a-z0-9]+")
WHITE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    path: int
    in_article: bool
    plain: bool
    style: int


def _is_noise(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in NEVER_SKIPPED:
        return False
    if name in SKIPPED or (name in SKIPPED_OUTSIDE and not in_article):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in SKIPPED_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    for given in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = PART.findall(given)
        if parts and (parts[0] in SKIPPED_NAMES or parts[-1] in SKIPPED_NAMES):
            return True
    return False


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order, without the branches that are no text by tag, role or class."""
    page = page or ""
    out: list[Block] = []
    # Open elements: name, path, read over, in an article, plain.
    open_: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, True)]
    parts: list[str] = []
    inline: list[str] = []

    def flush() -> None:
        if parts:
            text = WHITE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                _, path, _, inside, plain = open_[-1]
                out.append(Block(text, path, inside, plain, xxhash.xxh64_intdigest(",".join(inline).encode("utf-8", "replace"))))
            parts.clear()
        inline.clear()

    def close(depth: int) -> None:
        if any(e[0] in BLOCKS for e in open_[depth:]):
            flush()
        del open_[depth:]

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        text_end = found.start() if found else end
        if text_end > at and not open_[-1][2]:
            parts.append(page[at:text_end])
        if not found:
            break
        at = found.end()
        closing, name = found[1], found[2] or found[4]
        if closing:
            closing = closing.lower()
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth][0] == closing:
                    close(depth)
                    break
            continue
        if not name:
            continue
        name, given = name.lower(), (found[3] if found[2] else found[5]) or ""
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS:
            flush()
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth][0] == "p" or open_[depth][0] in CLOSES.get(name, ()):
                    close(depth)
                    break
                if open_[depth][0] in BLOCKS and open_[depth][0] not in ("td", "th"):
                    break
        elif not open_[-1][2]:
            inline.append(name)
        _, above, over, inside, plain = open_[-1]
        attributes = {}
        if given and not over:
            attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(given)}
        over = over or _is_noise(name, attributes, inside)
        if name in RAW:
            ends = re.compile(f"</{name}[^>]*>", re.I).search(page, at)
            at = ends.end() if ends else end
            continue
        if name in VOID or given.endswith("/"):
            continue
        if name in BLOCKS or over:
            label = f"{name}.{' '.join(sorted(attributes.get('class', '').split()))}#{attributes.get('id', '')}"
            path = xxhash.xxh64_intdigest(label.encode("utf-8", "replace"), above & 0x7FFFFFFFFFFFFFFF)
            inside = inside or name in ("article", "main") or attributes.get("role", "").lower() == "main"
            plain = name in PLAIN and not attributes.get("class") and not attributes.get("id") and (plain or name in ("article", "main"))
            plain = plain or name in ("article", "main", "html", "body")
        else:
            path = above
        open_.append((name, path, over, inside, plain))
    flush()
    article = [b for b in out if b.in_article]
    return article or out


def signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


NODE = "host string, path long, content long, style long, page long"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and path that is not plain text of an article: hashes of its texts and of their markup."""
    for batch in batches:
        out = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = blocks(page.as_py())
            whole = signed(xxhash.xxh64_intdigest("\n".join(b.text for b in found).encode("utf-8", "replace")))
            by_path: dict[int, list[Block]] = {}
            for b in found:
                if not (b.in_article and b.plain):
                    by_path.setdefault(b.path, []).append(b)
            for path, held in by_path.items():
                content = xxhash.xxh64_intdigest("\n".join(b.text for b in held).encode("utf-8", "replace"))
                style = xxhash.xxh64_intdigest(",".join(str(b.style) for b in held).encode())
                out.append((host, signed(path), signed(content), signed(style), whole))
        if out:
            kinds = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["host", "path", "content", "style", "page"])


def importance(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of the style tree nodes of ``pages`` (host, html); copies of a page count once."""
    nodes = pages.mapInArrow(_nodes, NODE).distinct()

    def entropy(of: str, name: str) -> DataFrame:
        counted = nodes.groupBy("host", "path", of).agg(F.count("*").alias("n")).groupBy("host", "path")
        # With m pages: H = -sum(n/m log(n/m)) / log(m) = 1 - sum(n log n) / (m log m).
        sums = counted.agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
        return sums.select("host", "path", F.col("m").alias("pages"), F.when(F.col("m") > 1, 1 - F.col("s") / (F.col("m") * F.log("m"))).otherwise(1.0).alias(name))

    both = entropy("content", "of_content").join(entropy("style", "of_style").drop("pages"), ["host", "path"])
    return both.select("host", "path", "pages", (CONTENT * F.col("of_content") + (1 - CONTENT) * F.col("of_style")).alias("importance"))


def host_of(url):
    """Lower-case host; null without one."""
    found = F.regexp_extract(F.lower(url), "^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def main_text(pages: DataFrame, html: str = "html", url: str = "url", text: str = "text", least: float = LEAST, least_pages: int = PAGES) -> DataFrame:
    """``pages`` without ``html``, with the main ``text`` and its length ``n_chars`` in code points.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by an empty
    line.  Null and empty pages have an empty text.  Pages without a host have no site and lose no branch to it.
    Repeated rows stay; input columns of the new names are replaced.
    """
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), text.lower(), "n_chars")]
    host, noise, given = (fresh(pages, n) for n in ("host", "noise", "given_html"))
    source = pages.select(*map(col, kept), host_of(col(url).cast("string")).alias(host), col(html).cast("string").alias(given))
    sites = source.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.col(given).alias("html"))
    low = importance(sites).where((F.col("importance") < least) & (F.col("pages") >= least_pages))
    # Paths of a host with many pages that show the same: bounded by the site's templates.
    by_host = stored(low.groupBy("host").agg(F.collect_list("path").alias("paths")), "noise").toDF(host, noise)
    joined = source.join(by_host, host, "left").select(*map(col, kept), F.col(noise), F.col(given))
    schema = T.StructType([*[joined.schema[c] for c in kept], T.StructField(text, T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for low_paths, page in zip(batch.column(len(kept)), batch.column(len(kept) + 1)):
                gone = set(low_paths.as_py() or ())
                found = blocks(page.as_py())
                texts.append("\n\n".join(b.text for b in found if (b.in_article and b.plain) or signed(b.path) not in gone))
            made = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], *made], names=[*kept, text, "n_chars"])

    return map_arrow(joined, run, schema)
