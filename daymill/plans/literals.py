"""Days and inline tables used by the queries and, word for word, by their SQL."""

ORDERS_AS_OF = "2001-07-31"
EVENTS_AS_OF = "2024-01-30"
OFFERS_NOW = "2001-08-02 12:00:00"
OPEN_SNAPSHOT_CUT = "2000-01-01"

_STATES = ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080", "60999"]
_CODES = (
    [(code, f"state {code}", "600") for code in _STATES]
    + [("70001", "parcel", "700"), ("70002", "document", "700"), ("70003", "fresh food", "700")]
    + [(f"8000{i}", f"collect {i}", "800") for i in range(1, 5)]
    + [("1101", "card", "11"), ("1102", "transfer", "11"), ("1103", "cash", "11")]
    + [("3101", "amount cut", "31"), ("3102", "count discount", "31"), ("3103", "discount", "31")]
    + [("3201", "amount cut", "32"), ("3202", "count discount", "32"), ("3203", "plain cut", "32")]
    + [(t, f"type {t.lower()}", "900") for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]
    + [(f"Brand#{i}", f"maker {i}", "910") for i in range(1, 26)]
    + [(str(i), f"kind {i}", "920") for i in range(0, 5)]
)
CODE_ROWS = ", ".join(f"('{c}', '{n}', '{p}')" for c, n, p in _CODES)
STATE_LIST = ", ".join(f"'{s}'" for s in _STATES)
DENY_LIST = ("the", "est", "und", "que", "license", "password", "copyright")
DENY_ROWS = ", ".join(f"('{w}')" for w in DENY_LIST)
