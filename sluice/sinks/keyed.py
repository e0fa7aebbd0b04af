"""A keyed table over plain Parquet files: a change rewrites the files that hold its keys, and old versions stay readable.

A table is a folder with data files, an index of them, and a list of versions. A version names its
files; they are never changed, so versions share those that stayed. Rows are laid out in cells, ranges
of the key that are fixed when the table is made. For each file the index has the smallest and largest
key and a bitmap of key hashes; a delta is met with the index first, and only with files that may hold
one of its keys after that. A new version is one small file that appears under its number at once: a
write that fails before leaves files that nobody reads, and of two writers one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import plain_unions, staged
from sluice.sinks.upsert import _row_hash, _same_key, _unseen, latest, upsert

# Cells of a table, and keys that are looked at per cell, about, to place the borders.
CELLS, KEYS_EACH = 256, 64
# Borders that are compared one by one; more are compared in two steps.
STEP = 16
# Bits of the bitmap per key, and of one row of Spark's bitmap functions.
KEY_BITS, BITMAP_ROW = 16, 32768


class Conflict(RuntimeError):
    """Another writer has published the same version."""


class KeyedTable:
    """One row per key; ``order_by`` tells which of two rows of a key is newer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        plain_unions(spark)
        about = json.loads(self._text(f"{self.root}/table.json"))
        self.schema = T.StructType.fromJson(about["schema"])
        self.keys, self.order_by = about["keys"], about["order_by"]
        self._borders: list | None = None

    # ---- files and versions

    def _store(self):
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.root)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _text(self, path: str) -> str:
        store, place = self._store()
        stream = store.open(place(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    @staticmethod
    def _publish(spark: SparkSession, path: str, text: str) -> None:
        """Write a text under a name that must not be there yet; readers see all of it or nothing."""
        jvm = spark._jvm
        paths, options = jvm.org.apache.hadoop.fs, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        target = paths.Path(path)
        draft = paths.Path(f"{path}.{uuid.uuid4().hex}")
        store = target.getFileSystem(spark._jsc.hadoopConfiguration())
        stream = store.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            paths.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
        except Exception as failed:
            store.delete(draft, False)
            raise Conflict(path) from failed

    def versions(self) -> list[int]:
        store, place = self._store()
        names = [s.getPath().getName() for s in store.listStatus(place(f"{self.root}/versions"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """``version``, ``operation``, ``batch`` and ``files`` (path, part, cell, rows, since) of a version, the last one by default."""
        version = self.versions()[-1] if version is None else version
        return json.loads(self._text(f"{self.root}/versions/{version:010d}.json"))

    def _commit(self, before: dict, files: list[dict], operation: str, batch: int | None) -> int:
        version = before["version"] + 1
        for f in files:
            f.setdefault("since", version)
        text = json.dumps({"version": version, "operation": operation, "batch": before["batch"] if batch is None else batch, "files": files})
        self._publish(self.spark, f"{self.root}/versions/{version:010d}.json", text)
        return version

    # ---- layout

    @property
    def _key(self) -> Column:
        return F.struct(*[F.col(f"`{k}`") for k in self.keys])

    def _cell(self) -> Column:
        """The number of borders at or below the key."""
        if self._borders is None:
            rows = self.spark.read.parquet(f"{self.root}/borders").orderBy("border").collect()
            self._borders = [r["border"] for r in rows]
        kinds = [self.schema[k].dataType for k in self.keys]

        def below(borders: list) -> Column:
            listed = [F.struct(*[F.lit(v).cast(t).alias(k) for k, t, v in zip(self.keys, kinds, b)]) for b in borders]
            return F.size(F.filter(F.array(*listed), lambda b: b <= self._key)) if listed else F.lit(0)

        coarse = self._borders[STEP - 1 :: STEP]
        fine = [self._borders[i : i + STEP - 1] for i in range(0, len(self._borders), STEP)]
        if not coarse:
            return below(self._borders)
        step = below(coarse)
        inside = reduce(lambda c, i: c.when(step == i, below(fine[i])), range(1, len(fine)), F.when(step == 0, below(fine[0])))
        return step * STEP + F.coalesce(inside, F.lit(0))

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | str, cells: int = CELLS
    ) -> KeyedTable:
        """A new table with the newest row per key of ``df`` as version 0; ``cells`` bounds the parts that one change can be held to.

        The borders of the cells come from some ``KEYS_EACH`` keys per cell, chosen by a hash; they decide where rows
        lie, not what is in the table.
        """
        root, order = root.rstrip("/"), [order_by] if isinstance(order_by, str) else list(order_by)
        plain_unions(spark)
        rows = staged(latest(df, keys, order), "keyed")
        key = F.struct(*[F.col(f"`{k}`") for k in keys])
        each = max(1, rows.count() // (cells * KEYS_EACH))
        seen = rows.where(F.pmod(F.xxhash64(key), F.lit(each)) == 0).select(key.alias("border"))
        # The chosen keys are few whatever the table: some KEYS_EACH per cell.
        every = Window.partitionBy(F.lit(0))
        ranked = seen.withColumn("nth", F.row_number().over(every.orderBy("border"))).withColumn("all", F.count(F.lit(1)).over(every))
        cut = F.floor(F.col("nth") * cells / F.col("all")) > F.floor((F.col("nth") - 1) * cells / F.col("all"))
        ranked.where(cut & (F.col("nth") < F.col("all"))).select("border").distinct().coalesce(1).write.parquet(f"{root}/borders")
        about = {"schema": json.loads(df.schema.json()), "keys": list(keys), "order_by": order}
        cls._publish(spark, f"{root}/table.json", json.dumps(about))
        table = cls(spark, root)
        table._commit({"version": -1, "batch": None}, table._written(rows), "create", None)
        return table

    def _written(self, rows: DataFrame) -> list[dict]:
        """Write rows as new files, by cell and in the order of the key, with their index; what a version says of them."""
        part = uuid.uuid4().hex
        data, index = f"{self.root}/data/{part}", f"{self.root}/index/{part}"
        laid = rows.withColumn("_cell", self._cell()).hint("rebalance", F.col("_cell"))
        laid.sortWithinPartitions("_cell", *[f"`{k}`" for k in self.keys]).write.partitionBy("_cell").parquet(data)
        store, place = self._store()
        if not any(s.getPath().getName().startswith("_cell=") for s in store.listStatus(place(data))):
            store.delete(place(data), True)
            return []
        held = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_cell", T.IntegerType())])).parquet(data)
        held = held.select(F.col("_metadata.file_path").alias("path"), F.col("_cell").alias("cell"), self._key.alias("key"))
        files = held.groupBy("path", "cell").agg(
            F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
        ).withColumn("width", (F.ceil(F.col("rows") * KEY_BITS / BITMAP_ROW) * BITMAP_ROW).cast("long"))
        files.write.parquet(f"{index}/files")
        files = self.spark.read.parquet(f"{index}/files")
        spot = F.pmod(F.xxhash64("key"), F.col("width"))
        held.join(files.select("path", "width"), "path").withColumn("spot", spot).groupBy(
            "path", F.expr("spot div 32768").alias("row")
        ).agg(F.bitmap_construct_agg((F.col("spot") % BITMAP_ROW).cast("long")).alias("bits")).write.parquet(f"{index}/bits")
        return [{"path": r["path"], "part": part, "cell": r["cell"], "rows": r["rows"]} for r in files.select("path", "cell", "rows").collect()]

    # ---- reading

    def _rows(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f["path"] for f in files])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one by default."""
        return self._rows(self.manifest(version)["files"])

    def _files_since(self, last: int) -> list[dict]:
        found: dict[str, dict] = {}
        for v in self.versions():
            if v <= last:
                found.update({f["path"]: f for f in self.manifest(v)["files"]})
        return list(found.values())

    def history(self, version: int | None = None) -> DataFrame:
        """Every row that any version up to ``version`` had, once, with the first version that had it as ``_since``.

        Only versions that are still there count; the files are those that the versions read.
        """
        last = self.versions()[-1] if version is None else version
        files = self._files_since(last)
        if not files:
            return self.spark.createDataFrame([], self.schema).withColumn("_since", F.lit(0))
        since = self.spark.createDataFrame([(f["path"], f["since"]) for f in files], "_path string, _since int")
        rows = self._rows(files).select("*", F.col("_metadata.file_path").alias("_file"))
        rows = rows.join(since, F.col("_file") == F.col("_path")).drop("_file", "_path")
        first = Window.partitionBy(*[F.col(f"`{k}`") for k in self.keys], _row_hash(self.spark.createDataFrame([], self.schema))).orderBy("_since")
        return rows.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")

    def changes(self, old: int, new: int) -> DataFrame:
        """What a later version has otherwise: its rows with ``_change`` insert or update, and rows that are gone with delete.

        Only files that the two versions do not share are read.
        """
        before, after = ({f["path"]: f for f in self.manifest(v)["files"]} for v in (old, new))
        was = self._rows([f for p, f in before.items() if p not in after])
        now = self._rows([f for p, f in after.items() if p not in before])
        mark, names = _row_hash(was), self.schema.names
        was = was.select(*[F.col(f"`{k}`").alias(f"_b{k}") for k in self.keys], mark.alias("_bmark"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_was"))
        now = now.withColumn("_mark", mark)
        both = now.join(was, _same_key(self.keys, "_b"), "full")
        change = F.when(F.col("_bmark").isNull(), "insert").when(F.col("_mark").isNull(), "delete").when(F.col("_mark") != F.col("_bmark"), "update")
        return both.withColumn("_change", change).where("_change IS NOT NULL").select(
            *[F.when(F.col("_change") == "delete", F.col("_was")[c]).otherwise(F.col(f"`{c}`")).alias(c) for c in names], "_change"
        )

    # ---- writing

    def _met(self, news: DataFrame, files: list[dict]) -> list[dict]:
        """The files that may hold a key of ``news``, by ranges and bitmaps of the index."""
        if not files:
            return []
        parts = sorted({f["part"] for f in files})
        live = self.spark.createDataFrame([(f["path"],) for f in files], "path string")
        index = self.spark.read.parquet(*[f"{self.root}/index/{p}/files" for p in parts]).join(live, "path")
        bits = self.spark.read.parquet(*[f"{self.root}/index/{p}/bits" for p in parts])
        keys = news.select(self._cell().alias("cell"), self._key.alias("key"))
        near = keys.join(index, "cell").where("low <= key AND key <= high").select("path", F.pmod(F.xxhash64("key"), F.col("width")).alias("spot"))
        spots = near.select("path", F.expr("spot div 32768").alias("row"), F.expr("int(spot % 32768)").alias("bit"))
        hit = F.expr("shiftright(int(conv(hex(substring(bits, bit div 8 + 1, 1)), 16, 10)), bit % 8) & 1") == 1
        found = {r["path"] for r in spots.join(bits, ["path", "row"]).where(hit).select("path").distinct().collect()}
        return [f for f in files if f["path"] in found]

    def _news(self, delta: DataFrame) -> DataFrame:
        return staged(latest(delta, self.keys, self.order_by).select(*[F.col(f"`{c}`") for c in self.schema.names]), "delta")

    def upsert(self, delta: DataFrame, batch: int | None = None) -> int:
        """Merge a delta, the larger ``order_by`` wins, a tie goes to the delta; the version that holds the result.

        A ``batch`` number at or below the last one has been merged before: nothing is done.
        """
        last = self.manifest()
        if batch is not None and last["batch"] is not None and batch <= last["batch"]:
            return last["version"]
        news = self._news(delta)
        met = self._met(news, last["files"])
        rows = upsert(self._rows(met), news, self.keys, self.order_by)
        gone = {f["path"] for f in met}
        stay = [f for f in last["files"] if f["path"] not in gone]
        return self._commit(last, stay + self._written(rows), "upsert", batch)

    def insert(self, delta: DataFrame, batch: int | None = None) -> int:
        """Add the rows of a delta whose key is not there yet; no file is rewritten."""
        last = self.manifest()
        if batch is not None and last["batch"] is not None and batch <= last["batch"]:
            return last["version"]
        news = self._news(delta)
        held = self._rows(self._met(news, last["files"]))
        fresh = _unseen(news, held.select(*[F.col(f"`{k}`") for k in self.keys]), self.keys)
        return self._commit(last, last["files"] + self._written(fresh), "insert", batch)

    def compact(self, most: int = 8, small: int = 100_000) -> int:
        """Write files of fewer than ``small`` rows anew, together, in cells that have more than ``most`` of them."""
        last = self.manifest()
        cells: dict[int, list[dict]] = {}
        for f in last["files"]:
            if f["rows"] < small:
                cells.setdefault(f["cell"], []).append(f)
        chosen = [f for files in cells.values() if len(files) > most for f in files]
        if not chosen:
            return last["version"]
        gone = {f["path"] for f in chosen}
        return self._commit(last, [f for f in last["files"] if f["path"] not in gone] + self._written(self._rows(chosen)), "compact", None)

    def retain(self, versions: int) -> None:
        """Keep the last ``versions`` versions; remove the others and the files that none of the kept ones names."""
        store, place = self._store()
        known = self.versions()
        kept, dropped = known[-versions:], known[:-versions]
        needed = {f["path"] for v in kept for f in self.manifest(v)["files"]}
        parts = {f["part"] for v in kept for f in self.manifest(v)["files"]}
        old = {f["path"]: f["part"] for v in dropped for f in self.manifest(v)["files"]}
        for v in dropped:
            store.delete(place(f"{self.root}/versions/{v:010d}.json"), False)
        for path in set(old) - needed:
            store.delete(place(path), False)
        for part in set(old.values()) - parts:
            for folder in ("data", "index"):
                store.delete(place(f"{self.root}/{folder}/{part}"), True)
