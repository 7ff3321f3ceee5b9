"""Personal data, and the terms around it that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Each
distinct value is a protected *entity*. From the whole corpus the operator
estimates how much a *term* (any word of a document that holds the entity,
outside the base spans) tells about it: the pointwise mutual information
PMI(term; entity) against the entity's information content IC = -ln p(entity).
Their ratio, the *disclosure*, is 1 where the term stands only in documents that
have the entity. A term counts by its greatest disclosure over the entities of
the document: from ``GENERALISE`` on it is replaced by its kind everywhere in
that document, from ``REMOVE`` on it is removed.

A word that stands in few documents has a high PMI with whatever stands beside
it, so a term counts only on evidence, of either kind:

* the entity stands in several contexts, and the term's disclosure still reaches
  ``GENERALISE`` with the lower confidence bound of p(entity | term);
* the document has many more terms as rare as this one than its number of terms
  lets expect: the corpus's share of such terms gives at most ``FALSE_SHARE`` of
  them, and as many by chance with a probability of at most ``CHANCE``.

So the usual rare words of ordinary text stay where they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from regstar.llm.common import row_key, ship, small_side, stage, text_of
from regstar.sources.tables import read_table

GENERALISE, REMOVE = 0.6, 0.9
#: Normal quantile of the lower confidence bound; evidence of a single document.
Z, FALSE_SHARE, CHANCE = 1.645, 0.2, 0.05
#: Words on either side of an entity that make its context.
CONTEXT = 3

#: Fixed values of the contract, in its order.
KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W_][\w'-]*")
#: Distinct terms that a task counts before it hands the counts on.
COUNTED_AT_ONCE = 200_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(t: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the local part's characters and ``DOMAIN``.

    Looks left from each @, so that long runs without one cost nothing.
    """
    free = 0
    at = t.find("@")
    while at >= 0:
        start = free + len(t[free:at].rstrip(LOCAL_PART))
        m = DOMAIN.match(t, at) if start < at else None
        free = m.end() if m else at + 1
        if m:
            yield start, free
        at = t.find("@", free)


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end), in order."""
    out = [(s, 0, e) for s, e in emails(t)] if "@" in t else []
    if DIGIT.search(t):
        for m in IP.finditer(t):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(t):
            d = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in t:
            for m in PHONE.finditer(t):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(rank: int, value: str) -> str:
    return f"{KINDS[rank]}:{value.lower() if rank == 0 else re.sub('[^0-9.]' if rank == 1 else '[^0-9]', '', value)}"


def terms_of(t: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Every word (lower-cased, start, end) of a text outside its base spans."""
    k, upto = 0, 0  # upto: the furthest end of the spans that begin before the word's end
    for m in WORD.finditer(t):
        while k < len(spans) and spans[k][0] < m.end():
            upto = max(upto, spans[k][2])
            k += 1
        if m.start() >= upto:
            yield m.group().lower(), m.start(), m.end()


def context_of(t: str, start: int, end: int) -> str:
    """The words next to a span, lower-cased; near copies of a passage have one context."""
    near = 40 * CONTEXT  # a word that is cut there is cut alike wherever the passage stands
    before = WORD.findall(t[max(0, start - near):start])[-CONTEXT:]
    after = WORD.findall(t[end:end + near])[:CONTEXT]
    return " ".join([*before, "|", *after]).lower()


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = pa.list_(pa.string())
    entity_type = pa.list_(pa.struct([("entity", pa.string()), ("context", pa.string())]))
    for b in batches:
        out = []
        for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if spans := base_spans(t):
                found: dict[str, str] = {}
                for s, r, e in spans:
                    name, context = entity(r, t[s:e]), context_of(t, s, e)
                    found[name] = min(found.get(name, context), context)
                out.append((key, [{"entity": n, "context": c} for n, c in sorted(found.items())], sorted({w for w, _, _ in terms_of(t, spans)})))
        if out:
            keys, entities, terms = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(entities, entity_type), pa.array(terms, texts)],
                                             names=["key", "entities", "terms"])


def holders(texts: DataFrame) -> DataFrame:
    """(key, entities with a context each, terms) of each row of texts (key, t) that holds an entity."""
    return stage(texts.mapInArrow(_holders, "key long, entities array<struct<entity:string,context:string>>, terms array<string>"), "holders")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"term": pa.array(list(n), pa.string()), "n": pa.array(list(n.values()), pa.int64())})

    n: Counter[str] = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            n.update({w.lower() for w in WORD.findall(t)})
            if len(n) >= COUNTED_AT_ONCE:
                yield out()
                n.clear()
    if n:
        yield out()


def rarity(n_term: Column) -> Column:
    """Terms in classes by their documents, two classes to a power of two (at most 128)."""
    return F.floor(2 * F.log2(n_term.cast("double")) + 1e-9).cast("int")


def rare_shares(of_term: DataFrame) -> DataFrame:
    """(rarity, share): the share of all (document, term) pairs whose term is in that class or a rarer one."""
    classes = of_term.groupBy(rarity(F.col("n_term")).alias("rarity")).agg(F.sum("n_term").alias("n"))
    order = Window.orderBy("rarity")  # at most 128 rows
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return classes.select("rarity", (upto / F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("share"))


def unusual_classes(terms: DataFrame, shares: DataFrame) -> DataFrame:
    """(key, rarity) of the classes of which a document has far more terms than chance gives it,
    from its terms (key, n_terms of the document, n_term)."""
    n = terms.groupBy("key", "n_terms", rarity(F.col("n_term")).alias("rarity")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("key").orderBy("rarity").rowsBetween(Window.unboundedPreceding, 0)  # at most 128 rows a key
    seen, by_chance = F.col("seen"), F.col("share") * F.col("n_terms")
    # Chernoff's bound of P(Poisson(by_chance) >= seen), for seen > by_chance
    log_p = seen - by_chance - seen * F.log(seen / by_chance)
    return (n.withColumn("seen", F.sum("n").over(upto)).join(F.broadcast(shares), "rarity")
            .filter((by_chance <= FALSE_SHARE * seen) & (log_p <= math.log(CHANCE))).select("key", "rarity"))


def disclosures(texts: DataFrame, held: DataFrame) -> DataFrame:
    """(key, term, disclosure) of the terms that give an entity of their row away,
    from texts (key, t) and their holders.

    Each row is a document. Only terms that can reach ``GENERALISE`` are
    paired with entities: PMI is at most -ln p(term). Entities of a single row
    have equal disclosures there and are paired as one.
    """
    n = float(max(texts.count(), 1))
    each = held.select("key", F.inline("entities"))
    of_entity = each.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    who = F.when(F.col("n_entity") == 1, F.concat(F.lit("only:"), F.col("key").cast("string"))).otherwise(F.col("entity"))
    context = F.when(F.col("n_entity") > 1, F.xxhash64("context"))
    entities = stage(each.join(of_entity, "entity").select("key", who.alias("entity"), "n_entity", context.alias("context")), "entities")
    most = float(entities.agg(F.max("n_entity")).first()[0] or 1)
    # PMI / IC >= GENERALISE needs n_term <= n ** (1 - GENERALISE) * n_entity ** GENERALISE; 1.001 is for rounding
    may = lambda n_entity: F.lit(1.001 * n ** (1 - GENERALISE)) * F.pow(n_entity, F.lit(GENERALISE))
    of_term = stage(texts.select("t").mapInArrow(_count_terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term")), "all-terms")
    shares = rare_shares(of_term)
    wanted = held.select(F.explode("terms").alias("term")).distinct()
    of_term = stage(of_term.filter(F.col("n_term") <= may(F.lit(most))).join(wanted, "term", "left_semi"), "terms")
    # rows of one key are equal, so their terms are paired once and counted with their number
    rows = held.groupBy("key").agg(F.first("terms").alias("terms"), F.count(F.lit(1)).alias("rows"))
    terms = stage(rows.select("key", "rows", F.size("terms").alias("n_terms"), F.explode("terms").alias("term")).join(small_side(of_term), "term"),
                  "terms-of-rows")
    unusual = unusual_classes(terms, shares).withColumn("unusual", F.lit(True))
    pairs = stage(terms.join(entities.distinct(), "key").filter(F.col("n_term") <= may(F.col("n_entity"))).drop("n_terms"), "pairs")
    both = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(
        F.sum("rows").alias("n_both"), F.coalesce(F.min("context") != F.max("context"), F.lit(False)).alias("varied"))
    ic = -F.log(F.col("n_entity") / F.lit(n))
    told = lambda p: F.when(ic > 0, (F.log(p) + ic) / ic).otherwise(0.0)  # noqa: E731 - p: probability of the entity given the term
    m, p = F.col("n_term").cast("double"), F.col("n_both") / F.col("n_term")
    # Wilson's lower bound
    low = (p + Z * Z / (2 * m) - Z * F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) / m + Z * Z / (4 * m * m))) / (1 + Z * Z / m)
    tell = both.select("entity", "term", told(p).alias("disclosure"), (F.col("varied") & (told(low) >= GENERALISE)).alias("sure"))
    tell = tell.filter(F.col("disclosure") >= GENERALISE)
    found = pairs.select("key", "entity", "term", rarity(F.col("n_term")).alias("rarity")).join(tell, ["entity", "term"])
    found = found.join(unusual, ["key", "rarity"], "left").filter(F.col("sure") | F.col("unusual").isNotNull())
    return found.groupBy("key", "term").agg(F.max("disclosure").alias("disclosure"))


def kind_of(word: str) -> str:
    """What a generalised term is replaced by."""
    return "[NUMBER]" if word[:1].isdigit() else "[NAME]" if word[:1].isupper() else "[TERM]"


RESULT = pa.struct([("counts", pa.list_(pa.int64())), ("base", pa.string()), ("spans", pa.string()), ("clean", pa.string())])


def _spans(keep_clean: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, known in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                base = base_spans(t)
                spans = [(s, r, e, KINDS[r], f"[{KINDS[r].upper()}]") for s, r, e in base]
                if known and base:
                    tell = {k["term"]: k["disclosure"] for k in known}
                    spans += [(s, 4, e, "term", "" if tell[w] >= REMOVE else kind_of(t[s:e])) for w, s, e in terms_of(t, base) if w in tell]
                spans.sort()
                named = [f"{k}:{s}:{e}" for s, _, e, k, _ in spans]
                clean = None
                if keep_clean:
                    parts, free = [], 0
                    for s, _, e, _, new in spans:
                        if s >= free:
                            parts += [t[free:s], new]
                        free = max(free, e)
                    clean = "".join(parts) + t[free:]
                out.append({"counts": [sum(r == k for _, r, _ in base) for k in range(len(KINDS))],
                            "base": ",".join(f"{KINDS[r]}:{s}:{e}" for s, r, e in base), "spans": ",".join(named), "clean": clean})
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, RESULT)], names=["row", "pii"])

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_clean: bool = False) -> DataFrame:
    """Each row as ``row`` with ``pii``: counts of the base kinds, base spans and all
    spans (``kind:start:end``, code points, comma-joined), and, if asked for, the text
    with base spans replaced by their kind and terms generalised or removed.

    NULL and empty texts have no spans. Rows without id are documents too. Repeated
    rows get equal results, and each counts in the statistics. Texts of any length
    are searched whole. An empty table gives an empty one. Extra columns of any
    name are carried in ``row``.
    """
    ship(docs.sparkSession)
    key = row_key(F.col(id_col), F.col(text_col))
    texts = docs.select(key.alias("key"), text_of(text_col).alias("t"))
    per_row = small_side(stage(disclosures(texts, holders(texts)).groupBy("key").agg(
        F.collect_list(F.struct("term", "disclosure")).alias("known")), "known-terms"))
    base = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("t"), key.alias("key")).join(per_row, "key", "left").select("row", "t", "known")
    kind = base.schema["row"].dataType.simpleString()
    return base.mapInArrow(_spans(keep_clean), f"row {kind}, pii struct<counts:array<bigint>,base:string,spans:string,clean:string>")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document."""
    found = find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", *[F.col("pii.counts")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(F.col("pii.base"), 256).alias("base_sha256"), F.col("pii.spans").alias("spans"))
