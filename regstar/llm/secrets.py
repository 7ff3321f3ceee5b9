"""Secret scans over a trigram inverted index, in DataFrame operations only.

For each rule's regular expression a Boolean query over trigrams is derived on
the driver (``trigram_query``): a disjunction of conjunctions that every text
with a match satisfies. The index holds a posting (trigram, document) for each
trigram of the rule set that a document has; trigrams that no rule asks for
would never be read and are not stored. Postings of one conjunction are
intersected by counting them per document, and only documents that satisfy a
rule's query are searched with its expression. Rules without mandatory trigrams
search every document.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass
from re import _constants as rc, _parser as rp

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regstar.llm.common import row_key, small_side, stage, text_of
from regstar.sources.tables import read_table


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` must mean the same to Python's and Java's
    regular expressions; ``group`` is measured against ``least`` characters, and
    shorter matches are dropped after the search."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False


#: Fixed values of the contract, in its order. A match of ``[0-9a-f]+`` is always a
#: whole run, and one of ``AKIA[A-Z0-9]+`` always reaches the end of its run, so the
#: least lengths stand in the patterns; short runs, of which prose is full, are then
#: never collected. ``assign`` may go on behind a short match and keeps its ``+``.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Further formats, as their issuers publish them. A pattern that begins with a run
#: starts at the run's beginning only, so a long run is read once, not from each place in it.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", r"-----BEGIN (RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("url_login", r"(?<![a-z])[a-z]+://[A-Za-z0-9._~-]+:[^\s/:@]+@[A-Za-z0-9]", 0, 12),
)
RULES = BASE_RULES + MORE_RULES

#: Strings and conjunctions beyond these numbers are given up for a weaker query.
MOST_STRINGS, MOST_CONJUNCTIONS = 32, 64
#: Trigrams that a conjunction keeps; fewer make a weaker query, never a wrong one.
MOST_TRIGRAMS = 6


def _fold(s: str) -> str:
    return s.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _and(a: set, b: set) -> set:
    both = {x | y for x in a for y in b}
    return both if len(both) <= MOST_CONJUNCTIONS else min((a, b), key=lambda q: (frozenset() in q, len(q)))


def _walk(parsed) -> tuple[set[str] | None, set[frozenset[str]]]:
    """(the strings it matches if they are few, else None; its trigram query).

    A query is a set of conjunctions; one that has the empty conjunction holds for every text.
    """
    run, query = {""}, {frozenset()}  # the strings of the literal run that is open, and what is known before it
    exact = True
    for op, arg in parsed:
        strings, sub = None, {frozenset()}
        if op is rc.LITERAL:
            strings = {_fold(chr(arg))}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg) and len(arg) <= 8:
            strings = {_fold(chr(a)) for _, a in arg}
        elif op is rc.SUBPATTERN:
            strings, sub = _walk(arg[3])
        elif op is rc.BRANCH:
            parts = [_walk(b) for b in arg[1]]
            strings = set().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
            sub = set().union(*(q if s is None else {_grams(x) for x in s} for s, q in parts))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, body = arg
            inner, inner_query = _walk(body)
            if low == 0 and high == 1 and inner is not None:
                strings = inner | {""}
            elif low >= 1:
                if inner is not None and high == 1:
                    strings = inner
                else:  # at least once: its own query holds, and the run ends here
                    sub = inner_query if inner is None else {_grams(x) for x in inner}
        if strings is not None and len(both := {a + b for a in run for b in strings}) <= MOST_STRINGS:
            run = both
            continue
        exact = False
        query = _and(query, {_grams(x) for x in run})
        if strings is not None:
            run = strings
        else:
            query, run = _and(query, sub), {""}
    if exact:
        return run, {_grams(x) for x in run}
    return None, _and(query, {_grams(x) for x in run})


def trigram_query(rule: Rule) -> list[frozenset[str]]:
    """Conjunctions of lower-cased trigrams, one of which each text with a match
    has; empty where the rule has no mandatory trigrams."""
    _, q = _walk(rp.parse(rule.pattern))
    if frozenset() in q:
        return []
    spread = lambda c: frozenset(sorted(c)[::-(-len(c) // MOST_TRIGRAMS)])
    return sorted({spread(c) for c in q if not any(o < c for o in q)}, key=sorted)


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(trigram, key) for every trigram of the rules' queries that a document has.

    The one-element array binds the lower-cased text to a name, so that it is
    made once and not for each trigram.
    """
    vocabulary = sorted({g for r in rules for c in trigram_query(r) for g in c})
    low = F.translate(F.col("t"), string.ascii_uppercase, string.ascii_lowercase)
    asked = F.array(*map(F.lit, vocabulary)) if vocabulary else F.expr("cast(array() as array<string>)")
    found = F.transform(F.array(low), lambda text: F.filter(asked, lambda g: F.contains(text, g)))[0]
    return (docs.select("key", F.explode_outer(found).alias("trigram")).filter(F.col("trigram").isNotNull())
            .select("trigram", "key").sortWithinPartitions("trigram", "key"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kinds): the rules whose trigram query a document satisfies."""
    clauses = [(r.kind, i, g, len(c)) for r in rules for i, c in enumerate(trigram_query(r)) for g in sorted(c)]
    asked = index.sparkSession.createDataFrame(clauses, "kind string, clause int, trigram string, size int")
    met = (index.join(F.broadcast(asked), "trigram").groupBy("key", "kind", "clause", "size")
           .agg(F.count_distinct("trigram").alias("n")).filter(F.col("n") == F.col("size")))
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost non-overlapping matches as an array of (start, rank, kind, end), in code points.

    The pieces between the matches and the matches themselves tile the text, so
    the sums of their lengths are the offsets.
    """
    pattern = ("(?i)" if rule.ignore_case else "") + rule.pattern
    p = F.lit(pattern)
    found = F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    step = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)").alias("out"))
    parts = [gaps.alias("gap"), found.alias("len")]
    if rule.group:
        parts.append(F.transform(F.regexp_extract_all(text, p, F.lit(rule.group)), F.length).alias("measured"))
    each = F.arrays_zip(*parts)

    def add(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        end = start + F.coalesce(m["len"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        keep = m["measured" if rule.group else "len"] >= rule.least  # NULL for the last piece, after which there is no match
        return F.struct(end.alias("at"), F.when(keep, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(each, step, add, lambda a: a["out"])


NO_SPANS = "cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row as ``row`` with ``spans``: (start, rank, kind, end) in order, in code points, end exclusive.

    NULL texts count as empty and have no spans; repeated rows get equal
    results, also rows without id; an empty table has no rows; extra columns of
    any name are carried in ``row``.
    """
    narrow = docs.select(text_of(text_col).alias("t"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    index = stage(postings(narrow, rules), "trigram-index")
    found = candidates(index, rules)
    base = docs.select(F.struct("*").alias("row")).select(
        "row", text_of(F.col("row")[text_col]).alias("t"),
        row_key(F.col("row")[id_col], F.col("row")[text_col]).alias("key")).join(found, "key", "left")
    each = []
    for rank, rule in enumerate(rules):
        here = matches(F.col("t"), rule, rank)
        found_here = F.array_contains("kinds", rule.kind) if trigram_query(rule) else F.col("t").rlike(("(?i)" if rule.ignore_case else "") + rule.pattern)
        each.append(F.when(found_here, here).otherwise(F.expr(NO_SPANS)))
    return base.select("row", "t", F.array_sort(F.flatten(F.array(*each))).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document."""
    found = find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in BASE_RULES]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select("row.doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


REDACTED = "[SECRET]"


def redact(found: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``find_secrets`` with every span replaced; overlapping spans become one.

    The columns and their types stay; ``length_col`` gets the new length.
    """
    runs = F.expr(
        "aggregate(spans, cast(array() as array<struct<start:int,end:int>>), (a, s) -> if(size(a) > 0 and s.start <= element_at(a, -1).end,"
        " array_append(slice(a, 1, size(a) - 1), struct(element_at(a, -1).start, greatest(element_at(a, -1).end, s.end) as end)),"
        " array_append(a, struct(s.start, s.end))))")
    kept = F.expr(
        "transform(sequence(0, size(runs)), i -> substring(t, if(i = 0, 0, runs[i - 1].end) + 1,"
        " if(i = size(runs), length(t), runs[i].start) - if(i = 0, 0, runs[i - 1].end)))")
    r = found.withColumn("runs", F.when(F.size("spans") > 0, runs)).withColumn(
        "clean", F.when(F.col("runs").isNotNull(), F.array_join(kept, REDACTED)))
    fields = found.schema["row"].dataType
    out = []
    for f in fields:
        c = F.col("row")[f.name]
        if f.name == text_col:
            c = F.coalesce(F.col("clean"), c)
        elif f.name == length_col:
            c = F.when(F.col("clean").isNotNull(), F.length("clean").cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return r.select(*out)
