import duckdb

from daymill.llm import preference, queries

SMALL = "/root/testdata/sf0.001"
TURNS = "pair_id long, turn long, role string, text string"


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    frame = queries.QUERIES["op3_preference"](spark, SMALL)
    cursor = con.execute(queries.ORACLES["op3_preference"])
    assert [d[0] for d in cursor.description] == frame.columns
    got = sorted(map(tuple, frame.collect()))
    assert got == sorted(cursor.fetchall()) and got


def pairs(spark, chosen, rejected):
    sides = (preference.numbered(spark.createDataFrame(s, TURNS)) for s in (chosen, rejected))
    return {r.pair: r for r in preference.preference_pairs(*sides).collect()}


def test_longest_common_prefix(spark):
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes 😀"), (1, 2, "user", "and"), (1, 3, "assistant", "more")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "and")]
    same = [(2, 5, "user", "a"), (2, 9, "assistant", "b")]
    ends = [(3, 0, "user", "a"), (3, 1, "assistant", "b")]
    found = pairs(spark, chosen + same + ends, rejected + same + ends[:1] + [(4, 0, "user", "only here")])
    r = found[1]
    assert (r.prompt_turns, r.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert r.chosen == "<|assistant|>\nyes 😀<|end|>\n<|user|>\nand<|end|>\n<|assistant|>\nmore<|end|>\n"
    assert [r.chosen[m.start : m.end] for m in r.chosen_mask] == ["yes 😀", "more"]
    assert [r.rejected[m.start : m.end] for m in r.rejected_mask] == ["no"]
    assert (found[2].prompt_turns, found[2].chosen, found[2].rejected, found[2].chosen_mask) == (2, "", "", [])
    assert (found[3].prompt_turns, found[3].rejected) == (1, "") and found[3].chosen
    assert 4 not in found


def test_odd_turns(spark):
    turns = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "system", "s"), (1, 0, "user", "x"), (None, 0, "user", "lost")]
    placed = preference.numbered(spark.createDataFrame(turns, TURNS)).orderBy("place").collect()
    assert [(r.role, r.text) for r in placed] == [("", ""), ("system", "s"), ("user", "x"), ("user", "x")]
    none = preference.numbered(spark.createDataFrame([], TURNS))
    assert preference.preference_pairs(none, none).count() == 0
    assert preference.preference_pairs(*preference.with_other_reply(none)).count() == 0


def test_the_next_reply_goes_round(spark):
    turns = [(i, t, r, f"{r} {i}") for i in (3, 5, 9) for t, r in enumerate(("user", "assistant"))] + [(6, 0, "user", "no reply")]
    sides = preference.with_other_reply(preference.numbered(spark.createDataFrame(turns, TURNS)))
    found = {r.pair: r.rejected for r in preference.preference_pairs(*sides).collect()}
    assert {k: v.split("\n")[1][:11] for k, v in found.items()} == {3: "assistant 5", 5: "assistant 9", 9: "assistant 3"}
