"""License scans by ordered signature rules, in SQL functions only.

A text is lower-cased (A-Z) and its words are joined by single spaces. Rules are regular
expressions over that form. They run behind two prefilters: a text without any of a few
gate words is left alone, and a rule runs only where its keyword occurs. Where detections
overlap, one that lies within another is suppressed, and of two that only overlap the
rule of the better priority stays.

No join, no shuffle: each row is scanned by itself, so repeated rows and null ids need no
care. A null text counts as empty: no words, no labels, score 0. Very long texts are
scanned whole.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose every place counts, and their labels
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# label | keyword | pattern of the name, over words joined by single spaces; the more special first
NAMES = """
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e(?: version| v)? v?3(?: 0)?
agpl-3.0 | agpl | agpl(?: version)? ?v?3(?: 0)?(?: only| or later)?
agpl | affero | (?:gnu )?affero general public licen[cs]e
lgpl-2.1 | lesser general | (?:gnu )?lesser general public licen[cs]e(?: version| v)? v?2 1
lgpl-2.1 | lgpl | lgpl(?: version)? ?v?2 1(?: only| or later)?
lgpl-3.0 | lesser general | (?:gnu )?lesser general public licen[cs]e(?: version| v)? v?3(?: 0)?
lgpl-3.0 | lgpl | lgpl(?: version)? ?v?3(?: 0)?(?: only| or later)?
lgpl | lesser general | (?:gnu )?lesser general public licen[cs]e
lgpl-2.0 | library general | (?:gnu )?library general public licen[cs]e(?: version| v)? v?2(?: 0)?
gpl-2.0 | general public | (?:gnu )?general public licen[cs]e(?: version| v)? v?2(?: 0)?
gpl-2.0 | gpl | (?:gnu )?gpl(?: version)? ?v?2(?: 0)?(?: only| or later)?
gpl-3.0 | general public | (?:gnu )?general public licen[cs]e(?: version| v)? v?3(?: 0)?
gpl-3.0 | gpl | (?:gnu )?gpl(?: version)? ?v?3(?: 0)?(?: only| or later)?
gpl | general public | (?:gnu )?general public licen[cs]e
gfdl-1.3 | free documentation | (?:gnu )?free documentation licen[cs]e(?: version| v)? v?1 3
gfdl-1.2 | free documentation | (?:gnu )?free documentation licen[cs]e(?: version| v)? v?1 2
gfdl | free documentation | (?:gnu )?free documentation licen[cs]e
apache-1.1 | apache | apache (?:software )?licen[cs]e(?: version| v)? v?1 1
apache-2.0 | apache | apache (?:software )?licen[cs]e(?: version| v)? v?2(?: 0)?
apache-2.0 | apache | apache 2(?: 0)?
mpl-1.1 | mozilla public | mozilla public licen[cs]e(?: version| v)? v?1 1
mpl-2.0 | mozilla public | mozilla public licen[cs]e(?: version| v)? v?2(?: 0)?
mpl-2.0 | mpl | mpl(?: version)? ?v?2(?: 0)?
epl-1.0 | eclipse public | eclipse public licen[cs]e(?: version| v)? v?1(?: 0)?
epl-2.0 | eclipse public | eclipse public licen[cs]e(?: version| v)? v?2(?: 0)?
cddl-1.0 | development and distribution | common development and distribution licen[cs]e(?: version| v)?(?: 1 0)?
eupl-1.2 | european union public | european union public licen[cs]e(?: version| v)?(?: 1 2)?
bsd-2-clause | bsd | (?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd)
bsd-3-clause | bsd | (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)
bsd-4-clause | bsd | (?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)
bsd-0-clause | bsd | (?:bsd zero clause|zero clause bsd|0bsd)
bsd | bsd | bsd
mit-0 | mit | mit(?: 0| no attribution)
mit | mit | mit
mit | expat | expat
isc | isc | isc
zlib | zlib | zlib(?: libpng)?
boost-1.0 | boost | boost software(?: licen[cs]e(?: version| v)?)?(?: 1 0)?
artistic-2.0 | artistic | artistic licen[cs]e(?: version| v)? v?2(?: 0)?
python-2.0 | python software | python software foundation
unlicense | unlicense | unlicense
wtfpl | wtfpl | wtfpl
postgresql | postgresql | postgresql
ofl-1.1 | open font | (?:sil )?open font licen[cs]e(?: version| v)?(?: 1 1)?
odbl-1.0 | open database | open (?:data commons )?open database licen[cs]e|open database licen[cs]e
odc-by-1.0 | data commons attribution | open data commons attribution licen[cs]e
cc0-1.0 | cc0 | cc0(?: 1 0)?
cc-by-nc-nd-{v} | cc by nc nd | cc by nc nd {v}
cc-by-nc-sa-{v} | cc by nc sa | cc by nc sa {v}
cc-by-nc-{v} | cc by nc | cc by nc {v}
cc-by-nd-{v} | cc by nd | cc by nd {v}
cc-by-sa-{v} | cc by sa | cc by sa {v}
cc-by-{v} | cc by | cc by {v}
cc-by-nc-nd | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s
cc-by-nc-sa | creative commons attribution | creative commons attribution non ?commercial share ?alike
cc-by-nc | creative commons attribution | creative commons attribution non ?commercial
cc-by-nd | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s
cc-by-sa | creative commons attribution | creative commons attribution share ?alike
cc-by | creative commons attribution | creative commons attribution
"""
VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")  # of the names with {v}

# priority, weight, and what stands around a name
FRAMES = (
    (1, 1.0, "spdx license identifier {name}"),
    (2, 0.95, "licen[cs]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?"),
    (3, 0.9, "(?:released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?"),
    (4, 0.8, "(?:the )?{name} licen[cs]e"),
)
# priority, weight, label, keyword, pattern: rules without a name
SINGLE = (
    (5, 0.7, "public-domain", "public domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    (5, 0.7, "proprietary", "proprietary", "proprietary and confidential"),
    (6, 0.4, "all-rights-reserved", "all rights reserved", "all rights reserved"),
    (7, 0.3, "copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
)
# a rule's match holds one of these, a base phrase too
GATES = ("licen", "spdx", "boost", "copyright", "rights", "domain", "proprietary", "cc", "under")

FOUND = "array<struct<start:int,neg_end:int,priority:int,label:string,weight:double>>"


class Rule(NamedTuple):
    priority: int
    weight: float
    label: str
    keyword: str
    pattern: str


def _names() -> list[tuple[str, str, str]]:
    out = []
    for line in NAMES.strip().splitlines():
        label, keyword, pattern = (part.strip() for part in line.split(" | ", 2))
        if "{v}" not in label:
            out.append((label, keyword, pattern))
            continue
        for v in VERSIONS:
            out.append((label.replace("{v}", v.replace(" ", ".")), keyword, pattern.replace("{v}", v)))
        out.append((label.removesuffix("-{v}"), keyword, pattern.removesuffix(" {v}")))
    return out


def rules() -> list[Rule]:
    """All rules, the better first. A keyword is part of every match of its rule."""
    framed = []
    for priority, weight, frame in FRAMES:
        for label, keyword, name in _names():
            whole = frame.replace("{name}", f"(?:{name})")
            if "licen" in name:  # the name itself says that it is one
                whole = whole.replace(") licen[cs]e", ")(?: licen[cs]e)?")
            framed.append(Rule(priority, weight, label, keyword, whole))
    return framed + [Rule(*s) for s in SINGLE]


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(words: Column, rule: Column) -> Column:
    """start, -end, priority, label, weight of each match of a rule, in words.

    Every word stands behind one space, so the spaces before a match are the number of
    its first word. ``split`` at a lookahead cuts before each match.
    """
    pattern = F.concat(F.lit(" (?:"), rule["pattern"], F.lit(")(?= )"))
    parts = F.split(words, F.concat(F.lit("(?="), pattern, F.lit(")")))

    def step(acc: Column, part: Column) -> Column:
        size = _spaces(F.regexp_substr(part, F.concat(F.lit("^"), pattern)))
        found = F.struct(
            acc["at"].alias("start"),
            (-acc["at"] - size).alias("neg_end"),
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            rule["weight"].alias("weight"),
        )
        return F.struct((acc["at"] + _spaces(part)).alias("at"), F.concat(acc["found"], F.array(found)).alias("found"))

    start = F.struct(_spaces(parts[0]).alias("at"), F.array().cast(FOUND).alias("found"))
    return F.aggregate(F.slice(parts, 2, F.size(parts)), start, step, lambda acc: acc["found"])


def _resolved(found: Column) -> Column:
    """labels and score of the detections that stay.

    They come in order of their start, the longer first. The last one is pending until the
    next shows whether it is overlapped by a better one.
    """

    def accepted(acc: Column) -> tuple[Column, Column]:
        has = acc["label"].isNotNull()
        labels = F.when(has, F.array_union(acc["labels"], F.array(acc["label"]))).otherwise(acc["labels"])
        return labels, F.greatest(acc["score"], F.coalesce(acc["weight"], F.lit(0.0)))

    def step(acc: Column, d: Column) -> Column:
        end = -d["neg_end"]
        within = end <= acc["end"]
        beside = d["start"] >= acc["end"]
        lost = within | (~beside & (d["priority"] >= acc["priority"]))
        labels, score = accepted(acc)
        take = F.struct(
            end.alias("end"),
            d["priority"].alias("priority"),
            d["label"].alias("label"),
            d["weight"].alias("weight"),
            F.when(beside, labels).otherwise(acc["labels"]).alias("labels"),
            F.when(beside, score).otherwise(acc["score"]).alias("score"),
        )
        return F.when(lost, acc).otherwise(take)

    start = F.struct(
        F.lit(0).alias("end"),
        F.lit(99).alias("priority"),
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("double").alias("weight"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"),
    )

    def finish(acc: Column) -> Column:
        labels, score = accepted(acc)
        return F.struct(labels.alias("labels"), score.alias("score"))

    return F.aggregate(F.array_sort(found), start, step, finish)


def _scan(words: Column, known: Column) -> Column:
    """All results for a text in its word form."""
    base = []
    for phrase, label in BASE.items():
        parts = F.split(words, F.lit(f"(?= {phrase} )"))
        n = F.size(parts) - 1
        base.append(
            F.struct(
                n.alias("n"),
                F.when(n > 0, _spaces(parts[0])).alias("first"),
                F.when(n > 0, _spaces(words) - _spaces(F.element_at(parts, -1))).alias("last"),
                F.when(n > 0, F.lit(label)).alias("label"),
            )
        )
    met = F.filter(known, lambda rule: F.contains(words, rule["keyword"]))
    found = F.flatten(F.transform(met, lambda rule: _places(words, rule)))
    return F.struct(F.array(*base).alias("base"), _resolved(found).alias("method"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: list[Rule] | None = None) -> DataFrame:
    """One row per row: the id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``more`` are further rules; the score is the greatest weight of the detections that
    stay, 1 for a base phrase.
    """
    known = F.array(
        *[
            F.struct(
                F.lit(r.priority).alias("priority"),
                F.lit(float(r.weight)).alias("weight"),
                F.lit(r.label).alias("label"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.pattern).alias("pattern"),
            )
            for r in [*rules(), *(more or [])]
        ]
    )
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    gate = reduce(lambda a, b: a | b, [F.contains("text", F.lit(g)) for g in GATES])
    words = F.concat(F.lit("| "), F.trim(F.regexp_replace("text", BETWEEN, " ")), F.lit(" "))
    found = F.when(gate, F.transform(F.array(words), lambda w: _scan(w, known))[0])
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), found.alias("found"))

    base, method = F.col("found.base"), F.col("found.method")
    base_labels = F.coalesce(F.array_compact(base["label"]), F.array().cast("array<string>"))
    own = F.coalesce(method["labels"], F.array().cast("array<string>"))
    n_base = F.coalesce(F.aggregate(base["n"], F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    return rows.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(base["first"]).cast("long").alias("first_word"),
        F.array_max(base["last"]).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.greatest(F.coalesce(method["score"], F.lit(0.0)), F.when(n_base > 0, 1.0).otherwise(0.0)).alias("score"),
    )
