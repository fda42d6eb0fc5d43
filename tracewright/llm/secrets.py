"""Secret scanning over a trigram inverted index, in DataFrame functions alone.

Each rule is a regular expression. From its parse tree follows a Boolean query over lower-cased trigrams that every match must contain: an OR of
ANDs. The index holds a posting (trigram, doc_id) for each trigram of these queries and each text that has it; intersecting the postings of a
conjunction leaves the candidates of its rule, whose texts alone are searched with the expression. A rule without mandatory trigrams searches every
text. Work is linear in rules and, but for sums over short stretches, in a text's matches.

Matches are leftmost and do not overlap within a rule; those that fail the rule's length are dropped after matching. Spans count code points, end
exclusive. Null texts count as empty; empty texts have no spans; rows that repeat an id are searched one by one (the index only has to know that
some row of an id is a candidate). Texts under a null id are searched in full. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import materialize, small


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int  # code points of the group
    group: int = 0
    base: bool = True


# The base rules, then those that the method adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, group=2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40, base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15, base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30, base=False),
)
WIDE = 64  # strings that an exact part of an expression may stand for; beyond that the part ends

Query = frozenset  # of frozensets of trigrams: any of them, each whole
ANY: Query = frozenset({frozenset()})


def _both(a: Query, b: Query) -> Query:
    return _least(frozenset(x | y for x in a for y in b))


def _least(q: Query) -> Query:
    return frozenset(x for x in q if not any(y < x for y in q))


def _grams(strings: set[str]) -> Query:
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _walk(items) -> tuple[set[str] | None, Query]:
    """The strings that these items stand for, if they are few, and the query of what they demand."""
    now, query, exact = {""}, ANY, True
    for op, arg in items:
        name, strings, demands = str(op), None, ANY
        if name == "LITERAL":
            strings = {chr(arg).lower()}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            strings = {chr(a).lower() for _, a in arg}
        elif name == "SUBPATTERN":
            strings, demands = _walk(arg[-1])
        elif name == "BRANCH":
            ways = [_walk(x) for x in arg[1]]
            strings = set().union(*(w[0] for w in ways)) if all(w[0] is not None for w in ways) else None
            demands = _least(frozenset().union(*(w[1] for w in ways)))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = arg
            inside, wants = _walk(inner)
            if inside is not None and (int(least), int(most)) == (0, 1):
                strings = {"", *inside}
            elif inside is not None and least == most and len(inside) ** int(least) <= WIDE:
                strings = {"".join(x) for x in itertools.product(inside, repeat=int(least))}
            elif least:
                demands = wants
        if strings is not None and len(now) * len(strings) <= WIDE:
            now = {a + b for a in now for b in strings}
        else:
            query, now, exact = _both(_both(query, _grams(now)), demands), {""}, False
    return (now if exact else None), _both(query, _grams(now))


def trigram_query(pattern: str) -> Query:
    """An OR of ANDs of lower-cased trigrams that each match contains; one empty AND if none are mandatory."""
    q = _walk(re._parser.parse(pattern))[1]
    return ANY if frozenset() in q else q


def build_index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, doc_id), written to the shared folder; one pass over the texts, no shuffle."""
    lower = F.lower(F.coalesce(F.col("text"), F.lit("")))
    has = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), lower.alias("lower"))
    present = F.array_compact(F.array(*(F.when(F.col("lower").contains(g), F.lit(g)) for g in grams)))
    return materialize(has.select("doc_id", F.explode(present).alias("gram")))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """doc_id and the kinds of the rules for which the intersected postings leave the document: all trigrams of some conjunction are there."""
    conjuncts = [(no, kind, sorted(c)) for no, (kind, c) in enumerate((k, c) for k, q in sorted(queries.items()) for c in sorted(q, key=sorted))]
    asked = [(g, no, kind, len(grams)) for no, kind, grams in conjuncts for g in grams]
    wanted = small(index.sparkSession.createDataFrame(asked, "gram string, conjunct int, kind string, need int"), len(asked))
    met = index.join(wanted, "gram").groupBy("doc_id", "conjunct", "kind", "need").agg(F.size(F.collect_set("gram")).alias("held")).filter("held = need")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


STRETCH = 256  # matches whose offsets are summed together
SPANS = "array<struct<start:int,kind_no:int,end:int,kind:string>>"


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) of the rule's matches in the text.

    Each expression runs once a text. Offsets are running sums over stretches of matches, so that no long list is copied for each match."""
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    searched = F.struct(F.split(text, rule.pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("found"), group.alias("group"))
    lengths = lambda c: F.transform(c, lambda x: F.length(x))
    # one element, so that what was searched for is bound to a name
    items = F.transform(F.array(searched), lambda s: F.arrays_zip(F.slice(lengths(s["between"]), 1, F.size(s["found"])).alias("gap"), lengths(s["found"]).alias("size"), lengths(s["group"]).alias("own")))
    stretches = F.transform(items, lambda a: F.transform(F.sequence(F.lit(0), F.greatest(F.size(a) - 1, F.lit(0)), F.lit(STRETCH)), lambda k: F.slice(a, k + 1, F.lit(STRETCH))))[0]

    def one(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("kind_no"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(x["own"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def some(acc: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, F.struct(acc["at"].alias("at"), F.array().cast(SPANS).alias("out")), one)
        # the sum is bound like the search above
        return F.transform(F.array(inner), lambda i: F.struct(i["at"].alias("at"), F.concat(acc["outs"], F.array(i["out"])).alias("outs")))[0]

    return F.aggregate(stretches, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("outs")), some, lambda acc: F.flatten(acc["outs"]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans: array of (start, kind_no, end, kind) of each row, by start and the rules' order."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != ANY}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if indexed:
        grams = sorted(set().union(*(c for q in indexed.values() for c in q)))
        hits = materialize(candidates(build_index(docs, grams), indexed))
        rows = rows.join(small(hits), "doc_id", "left")
    empty = F.array().cast(SPANS)
    per_rule = []
    for k, r in enumerate(rules):
        own = spans(F.col("text"), r, k)
        if r.kind in indexed:
            own = F.when(F.coalesce(F.array_contains("kinds", r.kind), F.col("doc_id").isNull()), own).otherwise(empty)
        per_rule.append(own)
    return rows.select("doc_id", F.sort_array(F.concat(*per_rule)).alias("spans"))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    base = [r.kind for r in rules if r.base]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scanned.select("doc_id", *(count(k).alias(f"n_{k}") for k in base), F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
