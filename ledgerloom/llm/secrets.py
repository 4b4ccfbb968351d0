"""Secret scans by a trigram inverted index: postings of trigrams propose documents, the regexes verify them.

From each rule's regex a Boolean query over trigrams is derived, as an OR of ANDs (clauses): every text that the
regex matches holds all trigrams of one clause. The index has one posting (trigram, document) for each trigram that
some rule names; postings are joined with the clauses by trigram and grouped by document and clause, which is their
intersection: a document stays where all trigrams of a clause have met. Only there the rule's regex runs. A rule
whose query is always true (no trigram must occur, such as a run of hex digits) runs on every text.

Trigrams are those of the lower-cased text, so a regex in either case needs one query; that can only add
candidates. Documents are known by id and a hash of the text: rows that share both have the same spans, and a
collision of hashes adds a candidate, which the regex then denies.

Built-in functions only. What a regex finds and what stands between gives the places, added up in blocks, so a long
text with very many matches costs no square.

Rules are written in the syntax that Java, Python and RE2 share. A match is leftmost and non-overlapping within its
rule; matches whose counted group is too short are dropped after that.

Defined results: null text counts as empty and has no spans; places are code points, the end exclusive; every row
gives a row, repeated ones too; null ids are ids like any other. Other columns do not matter. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import product
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regex, and how many characters the group (0: the match) has at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # a match of [0-9a-f]+ is a whole run, so runs of 32 and more are found alike by this
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("access_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"://[^\x20\x09-\x0D/:@]{1,64}:[^\x20\x09-\x0D/:@]{1,64}@"),
)

RULES = BASE + ADDED


# --- Boolean trigram queries -----------------------------------------------------------------

#: A query is a set of clauses, a clause a set of trigrams that must all occur; the empty clause is always true.
Query = frozenset[frozenset[str]]
TRUE: Query = frozenset([frozenset()])

#: Beyond so many strings or clauses a part of a regex is taken as less specific; queries stay necessary conditions.
MOST_STRINGS = 48
MOST_CLAUSES = 64


def _shortest(clauses: Iterable[frozenset[str]]) -> Query:
    """Without clauses that ask for more than another one does."""
    clauses = set(clauses)
    return frozenset(c for c in clauses if not any(other < c for other in clauses))


def _both(a: Query, b: Query) -> Query:
    found = _shortest(x | y for x, y in product(a, b))
    return found if len(found) <= MOST_CLAUSES else min(a, b, key=len)


def _either(parts: Iterable[Query]) -> Query:
    found = _shortest(clause for part in parts for clause in part)
    return found if len(found) <= MOST_CLAUSES else TRUE


def _trigrams_of(strings: Iterable[str]) -> Query:
    return _either([frozenset([frozenset(s[i:i + 3] for i in range(len(s) - 2))]) for s in strings])


@dataclass(frozen=True)
class Part:
    """What is known of all strings that a part of a regex matches: the strings, or how they begin and end."""

    exact: frozenset[str] | None
    begins: frozenset[str]
    ends: frozenset[str]
    query: Query = TRUE

    def opened(self) -> Part:
        """The same, with the strings told by their trigrams, begins and ends only."""
        if self.exact is None:
            return self
        return Part(
            None, frozenset(s[:2] for s in self.exact), frozenset(s[-2:] for s in self.exact), _trigrams_of(self.exact)
        )


def _strings(strings: Iterable[str]) -> Part:
    return Part(frozenset(strings), frozenset(), frozenset())


ANYTHING = Part(None, frozenset([""]), frozenset([""]))
NOTHING = _strings([""])


def _then(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return _strings(x + y for x, y in product(a.exact, b.exact))
    left, right = a.opened(), b.opened()
    query = _both(left.query, right.query)
    if len(left.ends) * len(right.begins) <= MOST_STRINGS:
        query = _both(query, _trigrams_of(x + y for x, y in product(left.ends, right.begins)))
    begins, ends = left.begins, right.ends
    if a.exact is not None and len(a.exact) * len(right.begins) <= MOST_STRINGS:
        begins = frozenset((x + y)[:2] for x, y in product(a.exact, right.begins))
    if b.exact is not None and len(b.exact) * len(left.ends) <= MOST_STRINGS:
        ends = frozenset((x + y)[-2:] for x, y in product(left.ends, b.exact))
    return Part(None, begins, ends, query)


def _one_of(parts: list[Part]) -> Part:
    if all(p.exact is not None for p in parts) and sum(len(p.exact) for p in parts) <= MOST_STRINGS:
        return _strings(s for p in parts for s in p.exact)
    opened = [p.opened() for p in parts]
    return Part(
        None, frozenset().union(*[p.begins for p in opened]), frozenset().union(*[p.ends for p in opened]),
        _either(p.query for p in opened),
    )


def _lowered(code: int) -> str:
    return chr(code + 32 if 65 <= code <= 90 else code)


def _class_part(items: list) -> Part:
    found: set[str] = set()
    for kind, value in items:
        if kind is K.LITERAL:
            found.add(_lowered(value))
        elif kind is K.RANGE and value[1] - value[0] < 8:
            found.update(_lowered(code) for code in range(value[0], value[1] + 1))
        else:
            return ANYTHING
    return _strings(found)


def _node_part(kind, value) -> Part:
    if kind is K.LITERAL:
        return _strings([_lowered(value)])
    if kind is K.IN:
        return _class_part(value)
    if kind is K.SUBPATTERN:
        return _sequence_part(value[-1])
    if kind is K.BRANCH:
        return _one_of([_sequence_part(branch) for branch in value[1]])
    if kind in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        least, most, inner = value
        part = _sequence_part(inner)
        if (least, most) == (0, 1) and part.exact is not None:
            return _one_of([NOTHING, part])
        if least == 0:
            return ANYTHING
        return part if least == most == 1 else part.opened()
    if kind in (K.AT, K.ASSERT, K.ASSERT_NOT):
        return NOTHING
    return ANYTHING


def _sequence_part(nodes) -> Part:
    part = NOTHING
    for kind, value in nodes:
        part = _then(part, _node_part(kind, value))
    return part


def trigram_query(pattern: str) -> Query:
    """Clauses of lower-case trigrams, one of which every text that the regex matches has in full."""
    return _sequence_part(_parser.parse(pattern)).opened().query


# --- index and candidates ----------------------------------------------------------------------

KEY = ["doc_key", "text_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").alias("doc_key"), F.xxhash64(text).alias("text_hash"), text.alias("body"))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index over the given trigrams: a row (trigram, document) where the document has the trigram."""
    lowered = _keyed(docs).select(*KEY, F.lower("body").alias("lowered"))
    held = [F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in trigrams]
    return lowered.select(*KEY, F.explode(F.array_compact(F.array(*held))).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_key, text_hash, rules (places in ``rules``): documents that hold all trigrams of one clause of a rule."""
    lines, named, clause = [], [], 0
    for place, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        for trigrams in sorted(map(sorted, query)) if query != TRUE else []:
            trigrams = trigrams[:62]  # asking for fewer is still necessary
            named += trigrams
            lines += [
                F.struct(
                    F.lit(place).alias("rule"), F.lit(clause).alias("clause"), F.lit(t).alias("trigram"),
                    F.lit(1 << bit).cast("long").alias("bit"), F.lit((1 << len(trigrams)) - 1).cast("long").alias("all_bits"),
                )
                for bit, t in enumerate(trigrams)
            ]
            clause += 1
    if not lines:
        return postings(docs, ["abc"]).where("false").select(*KEY, F.expr("cast(array() AS array<int>)").alias("rules"))
    asked = docs.sparkSession.range(1).select(F.inline(F.array(*lines)))
    found = postings(docs, sorted(set(named)))
    # the clauses are fixed by the rules: some tens of rows
    met = found.join(F.broadcast(asked), "trigram").groupBy(*KEY, "rule", "clause", "all_bits").agg(F.bit_or("bit").alias("met"))
    return met.where("met = all_bits").groupBy(*KEY).agg(F.collect_set("rule").alias("rules"))


# --- verification --------------------------------------------------------------------------------

BLOCK = 256


def _spans(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows (doc_key, body, rules) with ``spans``: array of (start, place of the rule, end), in order.

    Each step is a column of its own, so a regex runs once for a text. ``step`` leads from the start of
    one match to that of the next; steps are added up inside blocks and over the sums of blocks.
    """
    found, measured, summed, placed = [], [], [], []
    item = "array<struct<start:int,rule:int,end:int,held:int>>"
    for k, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        asked = F.lit(True) if trigram_query(rule.pattern) == TRUE else F.array_contains("rules", k)
        text = F.when(asked, F.col("body")).otherwise("")
        found += [
            F.regexp_extract_all(text, pattern, F.lit(0)).alias(f"match{k}"),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias(f"group{k}"),
            F.split(text, rule.pattern, -1).alias(f"between{k}"),
        ]
        measured.append(F.expr(f"""
            transform(match{k}, (m, i) -> struct(
              length(between{k}[i]) + if(i > 0, length(match{k}[greatest(i - 1, 0)]), 0) AS step,
              length(m) AS size, length(group{k}[i]) AS held))""").alias(f"step{k}"))
        summed.append(F.expr(f"""
            if(size(step{k}) = 0, cast(array() AS array<array<struct<step:int,size:int,held:int>>>),
               transform(sequence(0, greatest(size(step{k}) - 1, 0) div {BLOCK}), b -> slice(step{k}, cast(b * {BLOCK} + 1 AS int), {BLOCK})))
            """).alias(f"block{k}"))
        placed.append(F.expr(f"""
            flatten(transform(
              zip_with(block{k},
                aggregate(transform(block{k}, b -> aggregate(b, 0, (a, x) -> a + x.step)), array(0),
                          (a, x) -> concat(a, array(element_at(a, -1) + x))),
                (b, at) -> struct(b AS steps, at AS at)),
              b -> aggregate(coalesce(b.steps, array()), struct(b.at AS at, cast(array() AS {item}) AS spans),
                (a, x) -> struct(a.at + x.step AS at, concat(a.spans, array(struct(
                  a.at + x.step AS start, {k} AS rule, a.at + x.step + x.size AS end, x.held AS held))) AS spans),
                a -> filter(a.spans, s -> s.held >= {rule.least}))))""").alias(f"spans{k}"))
    kept = ["doc_key"]
    steps = docs.select(*kept, *found).select(*kept, *measured)
    blocks = steps.select(*kept, *summed)
    spans = blocks.select(*kept, *placed)
    every = F.concat(*[F.col(f"spans{k}") for k in range(len(rules))])
    bare = F.transform(F.sort_array(every), lambda s: F.struct(s["start"].alias("start"), s["rule"].alias("rule"), s["end"].alias("end")))
    return spans.select(*kept, bare.alias("spans"))


def _written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """doc_id and spans (array of start, rule, end) of every row; rules: the base ones, then the added ones."""
    rules = BASE + added
    rows, found = _keyed(docs), candidates(docs, rules)
    same = rows["doc_key"].eqNullSafe(found["doc_key"]) & (rows["text_hash"] == found["text_hash"])
    joined = rows.join(found, same, "left").select(
        rows["doc_key"], "body", F.coalesce("rules", F.expr("cast(array() AS array<int>)")).alias("rules")
    )
    return _spans(joined, rules).withColumnRenamed("doc_key", "doc_id")


def secret_report(docs: DataFrame, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """Every row: doc_id, numbers of base spans by kind, digest of the base spans, all spans as text."""
    rules = BASE + added
    base = F.filter("spans", lambda s: s["rule"] < len(BASE))
    counts = [
        F.expr(f"cast(size(filter(spans, s -> s.rule = {k})) AS bigint)").alias(f"n_{rule.kind}") for k, rule in enumerate(BASE)
    ]
    return secret_spans(docs, added).select(
        "doc_id", *counts, F.sha2(_written(base, rules), 256).alias("base_sha256"), _written(F.col("spans"), rules).alias("spans")
    )
