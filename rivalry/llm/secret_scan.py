"""Secret scans by a trigram inverted index, in DataFrame functions only.

1. ``trigram_query`` derives, from each rule's regular expression, a Boolean
   query over lower-case trigrams: AND over the literal runs that every match
   holds, OR over a run's alternatives, AND over an alternative's trigrams.
2. ``postings`` holds (trigram, doc_id) for the trigrams of all queries.
3. ``candidates`` intersects the postings: per document the trigrams present
   are OR-ed into one bit set (partially aggregated before the shuffle, no key
   larger than a document), and each rule's query is evaluated on it.
4. ``scan`` verifies each rule on its candidates only; a rule without
   mandatory trigrams scans every text.

The candidates are keys and bits, not texts; they meet the texts in a join
that broadcasts them behind a check of their size, and shuffles otherwise.

Null texts are empty; null ids are a key of their own; rows that share an id
share the candidate bits (a superset, then verified row by row); an empty
table gives no rows.  Other columns of the input play no part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.functions.joins import checked_broadcast
from rivalry.llm.store import fresh


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``least`` characters of ``group`` make a match count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: A private key: from its header to its END line, if no other line of five dashes comes first; else the header and what
#: looks like a key's body after it, lone dashes before its lines included.  A header that no key follows matches alone.
#: Loops over groups are bounded, as Java's regular expressions take stack for each round; RE2 and ``re`` agree with it.
PEM = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:"
       r"[^-]*(?:-{1,4}[^-]+){0,200}-{5,}END [A-Z ]*PRIVATE KEY-----|"
       r"(?:\\[rnt]|[^A-Za-z0-9/=]){0,16}(?:Proc-Type:|[A-Za-z0-9+/=]{16,})"
       r"[A-Za-z0-9+/=\t\n\r\x20\\\"',:;>#*|]*(?:-[A-Za-z0-9+/=\t\n\r\x20\\\"',:;>#*|]+){0,200})?")

RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    # Runs of 24 or more: the same matches as runs of any length, filtered.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", PEM),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

#: A literal run is followed through at most this many alternatives; beyond them it is cut, which only widens a query.
MAX_ALTERNATIVES = 64
Query = list[list[list[str]]]


def trigram_query(pattern: str) -> Query:
    """AND of ORs of ANDs of lower-case trigrams that each match of ``pattern`` holds; empty: no mandatory trigram."""
    runs: list[set[str]] = []
    last = _walk(rp.parse(pattern), {""}, runs)
    runs.append(last)
    query = []
    for run in runs:
        alternatives = [sorted({s[i:i + 3].lower() for i in range(len(s) - 2)}) for s in sorted(run)]
        if alternatives and all(alternatives):
            query.append(alternatives)
    return query


def _walk(items, run: set[str], runs: list[set[str]]) -> set[str]:
    """Follow a sequence: ``run`` holds the strings that may end here; a run that can't be followed moves to ``runs``."""
    for op, arg in items:
        if op is rc.SUBPATTERN:
            run = _walk(arg[-1], run, runs)
            continue
        found = None
        if op is rc.LITERAL:
            found = {chr(arg)}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            found = {chr(c) for _, c in arg}
        elif op is rc.BRANCH:
            sides: list[set[str]] = []
            for side in arg[1]:
                inner: list[set[str]] = []
                ends = _walk(side, {""}, inner)
                sides.append(ends if not inner else set())
            found = set().union(*sides) if all(sides) else None
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[:2] == (0, 1):
            inner = []
            ends = _walk(arg[2], {""}, inner)
            found = ends | {""} if not inner else None
        if found is not None and len(run) * len(found) <= MAX_ALTERNATIVES:
            run = {a + b for a in run for b in found}
        else:
            runs.append(run)
            run = {""}
    return run


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Inverted index (trigram number, doc_id) of ``docs`` for the given trigrams."""
    low = docs.select("doc_id", _lower(F.col("text")).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return low.select("doc_id", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, trigrams: list[str], queries: dict[str, Query]) -> DataFrame:
    """(doc_id, rules) of documents whose postings satisfy the query of at least one rule."""
    place = {t: i for i, t in enumerate(trigrams)}
    words = range((len(trigrams) + 62) // 63)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("trigram") % 63)
    sets = index.groupBy("doc_id").agg(*[
        F.bit_or(F.when(F.floor(F.col("trigram") / 63) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
        for w in words])

    def holds(t: str) -> Column:
        w, b = divmod(place[t], 63)
        return F.col(f"w{w}").bitwiseAND(F.lit(1 << b)) != 0

    def every(cols: list[Column]) -> Column:
        return _fold(cols, lambda a, b: a & b)

    rules = [F.when(every([_fold([every([holds(t) for t in alt]) for alt in run], lambda a, b: a | b) for run in q]),
                    F.lit(kind)) for kind, q in queries.items()]
    found = sets.select("doc_id", F.array_compact(F.array(*rules)).alias("rules"))
    return found.filter(F.size("rules") > 0)


def _fold(cols, join):
    out = cols[0]
    for c in cols[1:]:
        out = join(out, c)
    return out


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, number, end, kind) of a rule's matches, in code points, end exclusive.

    The texts between the matches and the matches alternate, so a running sum
    of their lengths gives the places.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    parts = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.arrays_zip(F.slice(parts, 1, F.size(parts) - 1).alias("gap"), F.transform(whole, F.length).alias("size"),
                         F.transform(value, F.length).alias("value"))
    span = "struct<start:int,number:int,end:int,kind:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["gap"]
        found = F.struct(at.alias("start"), F.lit(number).alias("number"), (at + x["size"]).alias("end"),
                         F.lit(rule.kind).alias("kind"))
        return F.struct((at + x["size"]).alias("at"),
                        F.when(x["value"] >= rule.least, F.concat(acc["out"], F.array(found))).otherwise(acc["out"])
                        .alias("out"))

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, into: str = "secrets") -> DataFrame:
    """``docs`` with a column ``into``: array of (start, number, end, kind), ordered by start, then rule."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for run in q for alt in run for t in alt})
    found = candidates(postings(docs, trigrams), trigrams, queries)
    doc, those = fresh(docs, "_doc", "_rules")
    found = checked_broadcast(found.select(F.col("doc_id").alias(doc), F.col("rules").alias(those)))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found[doc]), "left")
    text = F.coalesce(docs["text"], F.lit(""))
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    spans = []
    for n, rule in enumerate(rules):
        here = F.array_contains(those, rule.kind) if rule.kind in queries else text.rlike(rule.pattern)
        spans.append(F.when(here, _spans(text, rule, n)).otherwise(none))
    return joined.withColumn(into, F.array_sort(F.concat(*spans))).drop(doc, those)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret's text replaced by ``[kind]``; overlapping secrets become one, named by the first.

    Columns stay as they are, except that ``n_chars`` (if there) follows the new text.
    """
    cols, (spans,) = docs.columns, fresh(docs, "secrets")
    text = F.coalesce(F.col("text"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["),
                                   s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(spans, start, step,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    out = scan(docs, rules, spans).withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(F.col("text")))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*cols)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("secrets", lambda s: s["number"] < sum(r.base for r in RULES))
    counts = [F.expr(f"CAST(size(filter(secrets, s -> s.kind = '{r.kind}')) AS BIGINT)").alias(f"n_{r.kind}")
              for r in RULES if r.base]
    return scan(docs).select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                             _joined(F.col("secrets")).alias("spans"))


def _sql_spans(rule: Rule, number: int) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{p}')) + 1), lambda i: {{
        'start': coalesce(list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda x: length(x))), 0)
                 + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i - 1], lambda x: length(x))), 0),
        'number': {number},
        'size': length(regexp_extract_all(t, '{p}')[i]),
        'value': length(regexp_extract_all(t, '{p}', {rule.group})[i]),
        'kind': '{rule.kind}'}}), lambda s: s.value >= {rule.least})"""


def oracle() -> str:
    """DuckDB SQL of the query: every rule on every text."""
    lists = ", ".join(_sql_spans(r, n) for n, r in enumerate(RULES))
    line = "list_transform({}, lambda s: s.kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + s.size AS BIGINT))"
    base = "list_filter(all_spans, lambda s: s.number < 3)"
    counts = ", ".join(f"CAST(len(list_filter(all_spans, lambda s: s.kind = '{r.kind}')) AS BIGINT) AS n_{r.kind}"
                       for r in RULES if r.base)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id, list_sort(flatten([{lists}])) AS all_spans FROM texts)
SELECT doc_id, {counts}, sha256(array_to_string({line.format(base)}, ',')) AS base_sha256,
       array_to_string({line.format('all_spans')}, ',') AS spans FROM found"""


def brute_force(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int, str]]:
    """Spans of one text by Python's ``re``, for tests."""
    return sorted((m.start(), n, m.end(), r.kind) for n, r in enumerate(rules)
                  for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least)
