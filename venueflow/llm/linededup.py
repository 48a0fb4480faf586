"""Line deduplication against levelled sorted runs of line hashes.

A run is a table of (line hash, largest document holding the line, documents holding it), bucketed
and sorted by hash. Every batch of documents is reduced to such entries, merge-anti-joined with the
runs, and what remains becomes a run of its own: a line that a run already knows from enough
documents, and from a document at least as large, adds nothing. When a level holds ``FANOUT`` runs
they are merged into one run of the next level. The result depends neither on the order nor on the
cut of the batches, as long as all rows of a document are in one batch.

After the last batch the runs tell which lines go: those of keys held by ``MIN_DOCS`` documents or
more, everywhere but in the largest document holding them.

A line's key is the line without blanks at both ends, A-Z lower-cased; keys are told apart by two
64-bit hashes. Keys shorter than ``MIN_CHARS`` code points take no part.

Defined results: null and empty texts have one empty line; a text all of whose lines go is empty;
rows sharing an id are one document (they count once and keep their lines together); rows without
id are together one document, smaller than all others; an equal row gets an equal result; very long
texts are handled whole; an empty table gives an empty one. Columns ``n_lines`` and ``n_dropped`` of
the input are replaced, all others pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venueflow.llm.common import free_names
from venueflow.session import new_shared_path

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def hashes(value: Column) -> list[Column]:
    """Two 64-bit hashes of a value, with different seeds."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


class Runs:
    """The runs of all batches so far, by level."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []  # (table, folder) of every run

    def _write(self, entries: DataFrame) -> tuple[str, str]:
        name, folder = f"line_run_{uuid.uuid4().hex}", new_shared_path(self.spark, "line-run")
        entries.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", folder).format("parquet").saveAsTable(name)
        return name, folder

    def _all(self) -> list[str]:
        return [name for level in self.levels for name, _ in level]

    def add(self, lines: DataFrame) -> None:
        """Take in a batch ``lines(doc, k1, k2)``."""
        # A line in a third of all documents: the first shuffle is by line and document, the second one of partial sums.
        entries = lines.select("doc", *KEY).distinct().groupBy(*KEY).agg(F.max("doc").alias("holder"), F.count("*").alias("docs"))
        for name in self._all():
            run = self.spark.table(name).filter(F.col("docs") >= self.min_docs).select(*KEY, F.col("holder").alias("known"))
            later = entries["holder"].isNull() | (run["known"] >= entries["holder"])
            entries = entries.join(run.hint("merge"), (entries["k1"] == run["k1"]) & (entries["k2"] == run["k2"]) & later, "left_anti")
        self._put(0, self._write(entries))

    def _put(self, level: int, run: tuple[str, str]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self._put(level + 1, self._compact(self.levels[level]))
            self._drop(self.levels[level])
            self.levels[level] = []

    def _compact(self, runs: list[tuple[str, str]]) -> tuple[str, str]:
        """Merge runs: joins of tables bucketed and sorted alike, without a shuffle. (A union of bucketed tables must not be grouped:
        Spark 4.1 takes its partitions for hashed ones and leaves a key in several groups.)"""
        merged = self.spark.table(runs[0][0])
        for name, _ in runs[1:]:
            more = self.spark.table(name).withColumnsRenamed({"holder": "holder2", "docs": "docs2"})
            merged = merged.join(more.hint("merge"), KEY, "full_outer").select(
                *KEY, F.greatest("holder", "holder2").alias("holder"), (F.coalesce("docs", F.lit(0)) + F.coalesce("docs2", F.lit(0))).alias("docs")
            )
        return self._write(merged)

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, _ in runs:
            self.spark.sql(f"DROP TABLE {name}")  # its files stay, like checkpoints

    def repeated(self) -> DataFrame:
        """(k1, k2, holder) of the lines held by enough documents; ends the use of the runs."""
        runs = [run for level in self.levels for run in level]
        name, folder = runs[0] if len(runs) == 1 else self._compact(runs)
        schema = self.spark.table(name).schema
        self._drop(runs if len(runs) == 1 else [*runs, (name, folder)])
        self.levels = []
        return self.spark.read.schema(schema).parquet(folder).filter(F.col("docs") >= self.min_docs).select(*KEY, "holder")


def _without(text: Column, dropped: Column) -> Column:
    """The text without its lines at the positions in ``dropped``."""
    kept = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    # The outer transform binds the lines once, so that the inner one does not split the text again for each line.
    joined = F.transform(F.array(F.split(text, "\n")), lambda lines: F.array_join(F.transform(kept(lines), lambda i: F.get(lines, i)), "\n"))
    return F.when(F.coalesce(F.size(dropped), F.lit(0)) > 0, F.element_at(joined, 1)).otherwise(text)


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and n_lines (before) and n_dropped."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    body = F.coalesce(docs[text], F.lit(""))
    batch = F.pmod(F.xxhash64(docs[doc_id]), F.lit(batches)).cast("int")
    lines = docs.select(docs[doc_id].alias("doc"), *[h.alias(t) for h, t in zip(hashes(body), ("t1", "t2"))], batch.alias("batch"), F.posexplode(F.split(body, "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", line_key(F.col("line"))).filter(F.length("line") >= min_chars)
    lines = lines.select("doc", "t1", "t2", "pos", *[h.alias(k) for h, k in zip(hashes(F.col("line")), KEY)], "batch")
    folder = new_shared_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema(lines.schema).parquet(folder)
    runs = Runs(spark, min_docs, fanout)
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i))
    # A plain join of two shuffled sides, so Spark splits a hot line; positions of equal rows are merged before they are shuffled.
    gone = lines.join(runs.repeated().hint("merge"), KEY).filter(~F.col("doc").eqNullSafe(F.col("holder")))
    gone = gone.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("dropped"))
    (row, d, a, b, drops) = free_names(docs, "row", "gone_doc", "gone_t1", "gone_t2", "dropped")
    gone = gone.select(F.col("doc").alias(d), F.col("t1").alias(a), F.col("t2").alias(b), F.col("dropped").alias(drops))
    here = hashes(body)
    joined = docs.join(gone, docs[doc_id].eqNullSafe(gone[d]) & (here[0] == gone[a]) & (here[1] == gone[b]), "left")
    n_dropped = F.coalesce(F.size(gone[drops]), F.lit(0)).cast("long")
    n_lines = F.size(F.split(body, "\n")).cast("long")
    return joined.select(*[_without(docs[c], gone[drops]).alias(c) if c == text else docs[c] for c in names], n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def sql() -> str:
    """Lines dropped and kept, in DuckDB."""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH l AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents),
    k AS (SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS key FROM l),
    r AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
    j AS (SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.holder AS gone FROM k LEFT JOIN r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
    FROM j GROUP BY doc_id
    """
