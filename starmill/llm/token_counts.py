"""Token totals kept up to date by signed batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.manifest import exists
from starmill.sources.staging import shared_dir, stage

#: Tokenizer versions by name: the number of tokens of a text. More can be passed in.
TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "words-1": lambda text: F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")),
    "words-2": lambda text: F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")),
}
KEYS = ["source", "lang", "tokenizer"]
MANIFEST = "batch string, folder string"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def signed(docs: DataFrame, sign: int, versions: list[str], text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Deltas of documents that come (``sign`` 1) or go (-1): one row per document and version.

    Null text has no token; null sources and languages are keys like any other. ``keep`` names
    columns that stay, for a join after the counting, which so moves no text.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    counts = [F.struct(F.lit(v).alias("tokenizer"), TOKENIZERS[v](text).alias("n")) for v in versions]
    each = docs.select(*keep, "source", "lang", F.explode(F.array(*counts)).alias("c"))
    return each.select(
        *keep, "source", "lang", "c.tokenizer", F.lit(sign).cast("long").alias("n_docs"),
        (F.col("c.n") * sign).cast("long").alias("n_tokens"),
    )


def revised(docs: DataFrame, old: str, new: str, versions: list[str]) -> DataFrame:
    """Deltas of documents whose text changes from column ``old`` to column ``new``."""
    return signed(docs, -1, versions, old).unionByName(signed(docs, 1, versions, new))


class Rollup:
    """Additive totals in a folder that all executors share.

    A batch is rolled up on its keys, written under a name of its own, and counts from the
    moment its row is in the manifest. A batch that is already there is not applied again, and
    of two writers of one batch only one is read, so every batch may be repeated after a loss.
    A failed write leaves files that no row names.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.manifest = f"{self.folder}/manifest"
        spark.createDataFrame([], MANIFEST).write.mode("ignore").parquet(self.manifest)

    def _batches(self) -> DataFrame:
        rows = self.spark.read.schema(MANIFEST).parquet(self.manifest)
        return rows.groupBy("batch").agg(F.min("folder").alias("folder"))

    def compact(self) -> bool:
        """Roll all batches of the manifest up into one folder; False if there is nothing to do.

        The new folder counts from the moment the manifest says that it stands for these batches, so a
        loss before changes nothing. Their names stay known. Old folders are left to whoever cleans the store.
        """
        names = [r["batch"] for r in self._batches().collect()]
        whole = self._live()
        if len(whole) < 2:
            return False
        folder = f"{self.folder}/delta-{uuid.uuid4().hex}"
        self._rolled(self.spark.read.schema(TOTALS).parquet(*whole)).coalesce(1).write.parquet(folder)
        row = self.spark.createDataFrame([(n, folder) for n in names], MANIFEST).coalesce(1)
        row.write.mode("append").parquet(f"{self.folder}/compacted/{uuid.uuid4().hex}")
        return True

    def _live(self) -> list[str]:
        """The folders that count: of each batch its own, or the smallest compacted set that holds it."""
        own = {r["batch"]: r["folder"] for r in self._batches().collect()}
        path = f"{self.folder}/compacted"
        if exists(self.spark, path):
            sets = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(path)
            grouped = sets.groupBy("folder").agg(F.sort_array(F.collect_set("batch")).alias("names")).collect()
            for r in sorted(grouped, key=lambda r: (len(r["names"]), r["folder"])):  # later sets hold all earlier ones
                own |= {name: r["folder"] for name in r["names"]}
        return sorted(set(own.values()))

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Apply the batch once; False if it was applied before."""
        if not self._batches().filter(F.col("batch") == batch).isEmpty():
            return False
        folder = f"{self.folder}/delta-{uuid.uuid4().hex}"
        self._rolled(deltas).write.parquet(folder)
        row = self.spark.createDataFrame([(batch, folder)], MANIFEST).coalesce(1)
        row.write.mode("append").parquet(self.manifest)
        return True

    @staticmethod
    def _rolled(deltas: DataFrame) -> DataFrame:
        sums = deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``tokenizer``, ``n_docs``, ``n_tokens`` over all batches; keys at zero are gone."""
        folders = self._live()
        if not folders:
            return self.spark.createDataFrame([], TOTALS)
        return self._rolled(self.spark.read.schema(TOTALS).parquet(*folders))


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/starmill/rollup-{uuid.uuid4().hex}"


def counted(docs: DataFrame, versions: list[str], id_col: str = "doc_id") -> DataFrame:
    """One written row per document and version: ``n``, tokens of the whole text, ``n_last``, tokens of its last line
    if it has several, and ``twice``, whether the earlier state holds the document twice.

    Each text is read once. A newline parts words in every version, so a text without its last
    line has ``n - n_last`` tokens.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    last = F.when(F.contains(text, F.lit("\n")), F.substring_index(text, "\n", -1)).otherwise(F.lit(""))
    counts = [
        F.struct(F.lit(v).alias("tokenizer"), TOKENIZERS[v](text).alias("n"), TOKENIZERS[v](last).alias("n_last")) for v in versions
    ]
    rows = docs.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        (F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(16)) == 0).alias("twice"), F.explode(F.array(*counts)).alias("c"),
    )
    return stage(rows.select("source", "lang", "twice", "c.*"), "token-counts")


def _deltas(rows: DataFrame, sign: int, n: Column) -> DataFrame:
    return rows.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (n * sign).cast("long").alias("n_tokens"))


def corpus_totals(docs: DataFrame, versions: list[str] = ("words-1", "words-2"), id_col: str = "doc_id") -> DataFrame:
    """Totals over the whole texts of all rows, copies among them, reached by way of an earlier state.

    That state lacks the last line of every text and holds about one row in sixteen twice. A batch
    of revisions gives the texts back whole (the old count goes, the new one comes), one of deletions takes the additional
    rows out. The first batch is then sent again and changes nothing. Rows with null or repeated ids count like
    others; null sources and languages are keys; an empty table has no totals. No text is shuffled, and very long ones
    are read once like all.
    """
    spark, versions = docs.sparkSession, list(versions)
    store = Rollup(spark, new_folder(spark))
    rows = counted(docs, versions, id_col)
    extra, shorter = rows.filter("twice"), F.col("n") - F.col("n_last")
    earlier = _deltas(rows, 1, shorter).unionByName(_deltas(extra, 1, shorter))
    store.commit("earlier", earlier)
    store.commit("whole-texts", _deltas(rows, -1, shorter).unionByName(_deltas(rows, 1, F.col("n"))))
    store.commit("additional-rows", _deltas(extra, -1, shorter))
    store.commit("earlier", earlier)
    store.compact()
    return store.totals()
