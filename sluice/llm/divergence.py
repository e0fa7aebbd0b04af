"""Source divergence audit: which terms a source uses more than its language, and how far sources are apart.

The terms that at least ``MIN_DOCS`` documents of a language hold are found by iceberg prefix
refinement. A level counts, over all texts, the distinct documents of each term prefix of a
given number of bytes; prefixes below the threshold are discarded, the others are extended to
twice the length at the next level. A term is complete when it ends within a level's bytes; its
count is then its own, so complete terms at or above the threshold are kept with their
occurrences by source. The levels end when no longer prefix is left.

What a level hands to the next is a bitmap of the hashes of surviving prefixes, of bounded size.
It may let a discarded prefix through, which costs a count and changes nothing: a term's
documents are counted exactly at the level that completes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.workers import give_back
from sluice.session import discard, plain_unions, scratch_path, small_batches

MIN_DOCS = 30
TOP_TERMS = 50
# Bytes of the first level's prefixes; each level doubles them.
FIRST_LEVEL = 8
# Bytes of texts that are counted together; a longer text is counted on its own.
TOGETHER = 1 << 22
# The bitmap has at most so many bits, and so many for each surviving prefix as far as that allows.
MOST_BITS, BITS_EACH = 1 << 26, 16
# Bits of one row of Spark's bitmap functions.
BITMAP_ROW = 32768
# A task of the pair sums compares two blocks of so many sources over so many terms.
SOURCES, TERMS = 64, 2048

LEVEL = "lang string, source string, term binary, docs long, n long"
MIX = np.uint64(0x9E3779B97F4A7C15)

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
IN_TERM = (_BYTES >= 0x80) | _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))


def terms_in(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length in bytes of all terms in texts laid end to end, and the text of each.

    ``borders`` are the places where texts begin, and the end.
    """
    inside = IN_TERM[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = borders[(borders > 0) & (borders < len(data))]
    before[cuts], after[cuts - 1] = False, False
    starts = np.nonzero(inside & ~before)[0]
    sizes = np.nonzero(inside & ~after)[0] + 1 - starts
    return starts, sizes, np.searchsorted(borders, starts, side="right") - 1


def prefixes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` bytes of each term, filled up with zeros, as numbers of 8 bytes; no term holds a zero."""
    out = np.zeros((len(starts), -(-width // 8) * 8), np.uint8)
    for i in range(width):
        # Terms get fewer with their length, so late bytes cost little.
        rows = np.nonzero(sizes > i)[0]
        if not len(rows):
            break
        out[rows, i] = LOWER[data[starts[rows] + i]]
    return out.view(np.uint64)


def prefix_marks(keys: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """A hash per prefix and language, from the language's hash and the prefix in numbers of 8 bytes."""
    out = langs.copy()
    for i in range(keys.shape[1]):
        out = (out ^ keys[:, i]) * MIX
        out ^= out >> np.uint64(29)
    return out


def lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(v.encode()) for v in langs], np.uint64)


def _same(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of numbers: one place of each different row, and the number of each row among them."""
    number = np.zeros(len(keys), np.int64)
    place = np.zeros(min(1, len(keys)), np.int64)
    for i in range(keys.shape[1]):
        column = np.unique(keys[:, i], return_inverse=True)[1]
        _, place, number = np.unique(number << 32 | column, return_index=True, return_inverse=True)
    return place, number


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    columns = [pa.concat_arrays([b.column(i) for b in batches]) for i in range(batches[0].num_columns)]
    return pa.RecordBatch.from_arrays(columns, batches[0].schema.names)


def _level(width: int, last: int, bits: np.ndarray | None):
    """Counts over ``(lang, source, text)`` for prefixes of ``width`` bytes that extend survivors of ``last`` bytes.

    Complete terms are counted by source, prefixes of longer ones with a null source.
    """

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2)
        borders = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[borders[0] : borders[-1]] if held is not None else np.zeros(0, np.uint8)
        starts, sizes, doc = terms_in(data, borders - borders[0])
        langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
        lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (langs, sources))
        if last:
            # Shorter terms were complete at the last level.
            long = sizes >= last
            starts, sizes, doc = starts[long], sizes[long], doc[long]
            before = prefix_marks(prefixes(data, starts, np.minimum(sizes, last), last), lang_hashes(langs.dictionary.to_pylist())[lang[doc]])
            before &= np.uint64(len(bits) * 8 - 1)
            alive = bits[before >> np.uint64(3)] >> (before & np.uint64(7)).astype(np.uint8) & 1 == 1
            starts, sizes, doc = starts[alive], sizes[alive], doc[alive]
        keys = prefixes(data, starts, np.minimum(sizes, width), width)
        place, number = _same(keys)
        whole = sizes[place] < width
        # Each document counts once for a prefix; occurrences are added up.
        once, repeats = np.unique(doc << 32 | number, return_counts=True)
        doc, number = once >> 32, once & 0xFFFFFFFF
        group = lang[doc] * (len(sources.dictionary) + 1) + np.where(whole[number], source[doc] + 1, 0)
        pair, found = np.unique(group << 32 | number, return_inverse=True)
        group, number = pair >> 32, pair & 0xFFFFFFFF
        docs = np.bincount(found, minlength=len(pair))
        n = np.zeros(len(pair), np.int64)
        np.add.at(n, found, repeats)
        lang, source = group // (len(sources.dictionary) + 1), group % (len(sources.dictionary) + 1) - 1
        keys = keys[place[number]]
        lengths = np.minimum(sizes[place[number]], width)
        flat = keys.view(np.uint8).reshape(len(keys), 8 * keys.shape[1])
        term = flat[np.arange(flat.shape[1]) < lengths[:, None]]
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            langs.dictionary.take(pa.array(lang)),
            sources.dictionary.take(pa.array(source, mask=source < 0)),
            pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(term.tobytes())]),
            pa.array(docs.astype(np.int64)), pa.array(n),
        ], ["lang", "source", "term", "docs", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size >= TOGETHER:
                yield counted(_joined(waiting))
                waiting, size = [], 0
        if waiting:
            yield counted(_joined(waiting))
        give_back()

    return run


def _bitmap(survivors: DataFrame, count: int, width: int) -> np.ndarray:
    """The bitmap of ``(lang, term)``, prefixes of ``width`` bytes: ``MOST_BITS`` at most, so at most 8 MB reach the driver."""

    @F.pandas_udf("long")
    def mark(lang: pd.Series, term: pd.Series) -> pd.Series:
        codes, langs = pd.factorize(lang)
        keys = np.frombuffer(b"".join(bytes(t).ljust(-(-width // 8) * 8, b"\0") for t in term), np.uint64).reshape(len(term), -1)
        return pd.Series(prefix_marks(keys, lang_hashes(list(langs))[codes]).view(np.int64))

    marks = survivors.select(mark("lang", "term").alias("mark"))
    size = BITMAP_ROW
    while size < min(MOST_BITS, BITS_EACH * count):
        size *= 2
    spot = F.col("mark").bitwiseAND(F.lit(size - 1))
    rows = marks.groupBy((spot / BITMAP_ROW).cast("long").alias("row")).agg(
        F.bitmap_construct_agg((spot % BITMAP_ROW)).alias("bits")
    ).collect()
    out = np.zeros(size // 8, np.uint8)
    for r in rows:
        out[r["row"] * BITMAP_ROW // 8 :][: BITMAP_ROW // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def kept_terms(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, source, term, n)``: occurrences by source of the terms in ``min_docs`` and more documents of their language.

    ``texts`` has the strings ``lang``, ``source`` and ``text``, none null; each row is a document.
    The result is read from the shared folder.
    """
    spark = texts.sparkSession
    small_batches(spark)
    plain_unions(spark)
    width, last, bits, found = FIRST_LEVEL, 0, None, []
    while True:
        path, kept = scratch_path(spark, f"prefixes-{width}"), scratch_path(spark, f"terms-{width}")
        counts = texts.select("lang", "source", "text").mapInArrow(_level(width, last, bits), LEVEL)
        counts.groupBy("lang", "source", "term").agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("n")
        ).write.parquet(path)
        level = spark.read.parquet(path)
        # Only complete terms have a source.
        whole, open_ = level.where("source IS NOT NULL"), level.where((F.col("docs") >= min_docs) & F.col("source").isNull())
        enough = whole.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        whole.join(enough.select("lang", "term"), ["lang", "term"]).select(
            "lang", "source", F.col("term").cast("string").alias("term"), "n"
        ).write.parquet(kept)
        found.append(kept)
        survivors = open_.count()
        bits = _bitmap(open_, survivors, width) if survivors else None
        discard(spark, path)
        if not survivors:
            return spark.read.parquet(*found)
        width, last = 2 * width, width


def _apart(table: pa.Table) -> pa.Table:
    """Sums of absolute differences between the sources of two blocks, over the terms of one chunk.

    Rows without a term give a source's figure for the terms that it does not have.
    """
    term = table.column("term").combine_chunks().dictionary_encode()
    source = table.column("source").combine_chunks().dictionary_encode()
    at, who = term.indices.to_numpy(zero_copy_only=False), source.indices.to_numpy(zero_copy_only=False)
    p = table.column("p").to_numpy()
    base = np.isnan(at.astype(np.float64))
    absent, right = np.zeros(len(source.dictionary), np.int64), np.zeros(len(source.dictionary), bool)
    absent[who[base]], right[who[base]] = p[base], table.column("right").to_numpy(zero_copy_only=False)[base]
    figures = np.repeat(absent[:, None], len(term.dictionary), axis=1)
    figures[who[~base], at[~base].astype(np.int64)] = p[~base]
    own = table.column("x")[0].as_py() == table.column("y")[0].as_py()
    a, b, value = [], [], []
    for i in range(len(absent)):
        others = np.arange(len(absent)) if own else np.nonzero(right != right[i])[0]
        others = others[others != i]
        a.append(np.full(len(others), i))
        b.append(others)
        value.append(np.abs(figures[others] - figures[i]).sum(axis=1))
    return pa.table({
        "lang": pa.array([table.column("lang")[0].as_py()] * sum(map(len, a)), pa.string()),
        "source": source.dictionary.take(pa.array(np.concatenate(a))),
        "item": source.dictionary.take(pa.array(np.concatenate(b))), "value": pa.array(np.concatenate(value)),
    })


def _share(n: str, total: str):
    """1 + floor(10^9 (n + 5) / (total + 5 V)) in exact arithmetic; null where the language keeps no term."""
    return F.expr(
        f"CAST(1 + (CAST({n} + 5 AS DECIMAL(20, 0)) * 1000000000) div CAST(nullif({total} + 5 * v, 0) AS DECIMAL(20, 0)) AS BIGINT)"
    )


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """How far the sources of a language are apart, and which terms set each apart from its language.

    Columns: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. Part ``pair``: ``item`` is each
    other source of the language and ``value`` the sum over the language's kept terms of the absolute
    difference of the two smoothed shares. Part ``term``: ``item`` is a kept term that the source has and
    whose share is above the language's, ``value`` the difference; the ``top`` ranks. Ranks are by value,
    ties by item.

    Each row is a document, also a repeated one or one without an id. Null text, language and source are
    empty strings. A language that keeps no term has pairs with value 0 and no terms; an empty table gives
    no rows. Other columns of ``docs`` take no part, whatever their names.
    """
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = kept_terms(named, min_docs)

    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = named.select("lang", "source").distinct()
    listed = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(langs, "lang", "left").select(
        "lang", "sources", F.coalesce("v", F.lit(0)).alias("v"), "lang_total",
    )
    figures = groups.join(totals, ["lang", "source"], "left").join(listed, "lang").withColumn(
        "total", F.coalesce("total", F.lit(0))
    )
    shares = counts.join(figures, ["lang", "source"]).withColumn("p", _share("n", "total"))

    above = shares.join(of_lang, ["lang", "term"]).withColumn("value", F.col("p") - _share("lang_n", "lang_total")).where("value > 0")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    chunks = F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).cast("int")
    blocks = F.ceil(F.col("sources") / SOURCES).cast("int")
    block = F.pmod(F.xxhash64("source"), blocks).cast("int")
    present = shares.select("lang", F.pmod(F.xxhash64("term"), chunks).cast("int").alias("chunk"), "source", block.alias("block"), blocks.alias("blocks"), "term", "p")
    absent = figures.select(
        "lang", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), "source", block.alias("block"), blocks.alias("blocks"),
        F.lit(None).cast("string").alias("term"), F.coalesce(_share("0", "total"), F.lit(0)).alias("p"),
    )
    met = present.unionByName(absent).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "chunk", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).alias("right"), "source", "term", "p",
    )
    sums = met.groupBy("lang", "chunk", "x", "y").applyInArrow(_apart, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [
        part.withColumn("rank", F.row_number().over(order)).where(limit)
        for part, limit in ((pairs, F.lit(True)), (terms, F.col("rank") <= top))
    ]
    return ranked[0].unionByName(ranked[1])
