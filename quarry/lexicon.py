"""Lexicons: keyword groups, expansion lists, rerank words and tag patterns.

Operators take plain Python structures (small, declared in order) and embed
them in the plan as literal arrays, or take a lexicon DataFrame when the list
is large.  The engine ships short example lists only; applications pass their
own.  ``LATIN_*`` lists are the ones the driver-data queries use.
"""

from __future__ import annotations

# Examples about a public library's help desk.
# Scope groups: (label, keywords) in declared order; the first group hit wins.
EXAMPLE_SCOPE_GROUPS = [
    ("opening hours", ["opening hours", "closed on", "holiday"]),
    ("parking", ["parking", "bicycle stand"]),
    ("catering", ["cafe", "vending machine"]),
]

# Expansion lists: (keyword, [expanded queries]) in declared order.
EXAMPLE_EXPANSIONS = [
    ("overdue", ["overdue items and fees", "late return rules"]),
    ("renew", ["renewal of a loan"]),
    ("card", ["library card application"]),
]

# The two generic templates used when no expansion keyword hits.
EXPANSION_TEMPLATES = ["刑法 {q} 处罚", "{q} 有期徒刑 罚金"]

EXAMPLE_RERANK_WORDS = ["loan", "overdue", "renew", "card", "fee"]

# --- Latin-script lists used by the driver-data queries --------------------
LATIN_SCOPE_GROUPS = [
    ("german", ["keit", "sich ", " und "]),
    ("spanish", ["ción", " del "]),
    ("french", ["eaux", " pour "]),
    ("english-legal", ["thre "]),
    ("other", ["zz", "qq"]),
]
LATIN_EXPANSIONS = [
    ("tion", ["tion statute penalty", "tion general rule"]),
    ("the ", ["the law and the offence"]),
    ("that", ["that which is punishable"]),
    ("with", ["with intent and with force"]),
]
LATIN_TEMPLATES = ["law {q} penalty", "{q} prison fine"]
LATIN_RERANK_WORDS = ["the", "and", "that", "with", "from", "tion", "der", "que", "des"]
LATIN_TAGS = [
    ("motion", ["tion"]),
    ("movement", ["ment"]),
    ("quality", ["keit", "heit"]),
    ("spanish", ["ción"]),
    ("none", ["xyzzy"]),
]
