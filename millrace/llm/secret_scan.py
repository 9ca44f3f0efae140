"""Secret scans over every version of a file ever seen, each blob and rule version scanned once.

A version's content address is the SHA-256 of its text. A ledger (a Parquet folder the caller names) keeps, for
each blob, the rule versions that have scanned it and what they found. A scan takes the distinct blobs of
its input, asks the ledger which pairs of blob and rule version are missing, scans those alone, appends them,
and joins findings back to all paths. Raising a rule's version scans every blob again for that rule only.

Spans are code points, end exclusive. A null text is an empty one, which has no findings. Rows that
repeat an id or a text are rows of their own, with equal findings. An empty table gives no rows and leaves
the ledger as it is. Columns other than doc_id and text are ignored. A scan that fails leaves nothing
in the ledger; the next one repeats it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fresh, slices, texts, tidy
from millrace.operators.ordered import join_groups
from millrace.session import materialise


@dataclass(frozen=True)
class Rule:
    """A pattern, the version of its meaning, and what a match must fulfil besides."""

    pattern: str
    version: int = 1
    accept: Callable[[re.Match], bool] = lambda match: True


# The three base rules. The others are added to them.
BASE = {
    "assign": Rule(
        r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        accept=lambda m: len(m[1]) >= 6,
    ),
    "access": Rule(r"AKIA[A-Z0-9]{16,}"),
    "hex": Rule(r"[0-9a-f]{24,}"),
}
RULES = BASE | {
    "pem": Rule(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    # Begins a run, and runs are not given back: else a run of its own prefixes would be walked from each of them.
    "jwt": Rule(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{16,}+", version=2),
    "forge": Rule(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "chat": Rule(r"xox[abprs]-[A-Za-z0-9-]{20,}"),
}

SPAN = "struct<start:long,rank:int,end:long,kind:string>"
LEDGER = f"blob string, rules array<string>, spans array<{SPAN}>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def names(rules: Mapping[str, Rule]) -> dict[str, str]:
    """Kind to rule version, as the ledger holds it."""
    return {kind: f"{kind}@{rule.version}" for kind, rule in rules.items()}


def find(text: str, rules: Mapping[str, Rule]) -> list[tuple[str, int, int]]:
    """(kind, start, end), leftmost and without overlap per kind; failing matches are dropped."""
    return [(k, m.start(), m.end()) for k, r in rules.items() for m in re.finditer(r.pattern, text) if r.accept(m)]


def _read(spark: SparkSession, ledger: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def extend(docs: DataFrame, ledger: str, rules: Mapping[str, Rule] = RULES) -> None:
    """Scan the pairs of blob and rule version that the ledger lacks and append them.

    Texts are shuffled once, by blob, after each task has dropped its own copies.
    """
    spark, wanted, order = docs.sparkSession, names(rules), {k: i for i, k in enumerate(RULES | dict(rules))}
    blobs = texts(docs).select(blob_id(F.col("text")).alias("blob"), "text").dropDuplicates(["blob"])
    every = F.array(*[F.lit(v) for v in wanted.values()])
    known = _read(spark, ledger)
    if known is None:
        todo = blobs.withColumn("rules", every)
    else:
        done = known.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
        missing = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
        todo = blobs.join(done, "blob", "left").withColumn("rules", missing).where(F.size("rules") > 0)

    def run(batches: Iterable[pa.RecordBatch]):
        schema = pa.schema([
            ("blob", pa.string()), ("rules", pa.list_(pa.string())),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())]))),
        ])
        by_set: dict[tuple, dict[str, Rule]] = {}
        for batch in slices(batches):
            rows = []
            for blob, asked, text in zip(*[batch[c].to_pylist() for c in ("blob", "rules", "text")], strict=True):
                some = by_set.setdefault(tuple(asked), {k: r for k, r in rules.items() if wanted[k] in asked})
                spans = [{"start": a, "rank": order[k], "end": b, "kind": k} for k, a, b in find(text, some)]
                rows.append({"blob": blob, "rules": asked, "spans": spans})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    todo.select("blob", "rules", "text").mapInArrow(tidy(run), LEDGER).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """(blob, spans) by the wanted rule versions, in the order of start, then kind."""
    wanted = F.array(*[F.lit(v) for v in names(rules).values()])
    known = spark.read.schema(LEDGER).parquet(ledger)
    kinds = F.transform(F.array_intersect("rules", wanted), lambda r: F.substring_index(r, "@", 1))
    own = F.filter("spans", lambda s: F.array_contains(F.col("__kinds"), s["kind"]))
    rows = known.withColumn("__kinds", kinds).withColumn("spans", own)
    # As many rows for a blob as scans that had something to add.
    return rows.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def report(docs: DataFrame, ledger: str, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for every row of ``docs``, all of whose blobs the ledger has."""
    spark = docs.sparkSession
    if _read(spark, ledger) is None:
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    # Stored, so that adaptive execution can split a blob that very many paths share.
    found = materialise(findings(spark, ledger, rules), "findings")
    return join_groups(docs.select("doc_id", blob_id(F.col("text")).alias("blob")), found, ["blob"])


def scan(docs: DataFrame, ledger: str, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for every row of ``docs``, after extending the ledger."""
    extend(docs, ledger, rules)
    return report(docs, ledger, rules)


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, ledger: str, rules: Mapping[str, Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """The rows with every found span replaced by ``mark``; rows without findings keep their text.

    ``n_chars``, where the column exists, follows the new text. Overlapping spans become one mark. The join is a
    merge at every size, as findings grow with the table.
    """
    extend(docs, ledger, rules)
    found = materialise(findings(docs.sparkSession, ledger, rules).where(F.size("spans") > 0), "findings")
    key, blob, spans = (fresh(docs, n) for n in ("__key", "__blob", "__spans"))
    found = found.select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    rows = docs.withColumn(key, blob_id(F.col("text"))).join(found.hint("merge"), F.col(key) == F.col(blob), "left")
    # Spans ascend by start; fold them into (text so far, place reached).
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state, span):
        new = span["start"] >= state["at"]
        kept = F.substr(F.col("text"), (state["at"] + 1).cast("int"), F.greatest(span["start"] - state["at"], F.lit(0)).cast("int"))
        done = F.when(new, F.concat(state["done"], kept, F.lit(mark))).otherwise(state["done"])
        return F.struct(done.alias("done"), F.greatest(state["at"], span["end"]).alias("at"))

    text = F.aggregate(spans, start, step, lambda s: F.concat(s["done"], F.substr(F.col("text"), (s["at"] + 1).cast("int"))))
    clean = F.col(spans).isNull()
    changed = rows.withColumn("text", F.when(clean, F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        chars = F.when(clean, F.col("n_chars")).otherwise(F.length("text"))
        changed = changed.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
