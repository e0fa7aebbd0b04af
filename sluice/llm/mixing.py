"""Mixing sources to target weights by Sainte-Laguë apportionment.

The targets of all sources are divided into equal-token blocks, dealt to the sources by the
highest quotients (target / 1, / 3, / 5, ...): with a block's words as the divisor, a source
gets its target over the block's words, rounded. A small source has blocks a power of two
finer, so its words come as near to its target whatever the number of sources.

A source's documents are spread over shards by a seeded hash and laid end to end there. Its
quota counts as whole passes over all of it and the rest; the source's blocks and the rest of
the quota are dealt to its shards by the same rule, from the words of each. A shard's line of
words is cut into as many equal blocks as it got, and as many as its quota says are taken, those
with the least seeded hash.

Sources, targets and quotas are columns of frames; the driver gets sums over all sources. A task
deals the quota of a source that has several shards, a row for each of them. Shards follow the
words and documents, so no task grows with the corpus.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.names import spare
from sluice.llm.workers import give_back
from sluice.operators.ranks import running
from sluice.session import durable, plain_unions, small_batches, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# Blocks that all targets together are divided into at least, and the least that one target has.
SEATS = 16384
LEAST_SEATS = 512
# Words of a block at most, so that there are more of them as the corpus grows.
BLOCK_WORDS = 1 << 20
# Blocks of a shard at most, and documents of a shard as far as it keeps as many blocks as the last figure.
SHARD_BLOCKS, SHARD_DOCS, FEW_BLOCKS = 1024, 1 << 16, 8
SEED = 42
# A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets that add up to ``share`` of all sizes, by weight, none above ``most`` times its size.

    What a source cannot take is shared among the others by weight until none is above.
    """
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in sorted(open_) if unit * weights[i] > most * sizes[i]]
        for i in full or sorted(open_):
            out[i] = float(most * sizes[i]) if full else unit * weights[i]
            left -= out[i]
            open_.remove(i)
    return out


def sainte_lague(votes: Sequence[float], seats: int, caps: Sequence[int] | None = None) -> list[int]:
    """``seats`` dealt to the highest quotients votes / (2 s + 1), ties to the first, none above its cap."""
    caps = [seats] * len(votes) if caps is None else [min(c, seats) for c in caps]
    caps = [c if v > 0 else 0 for v, c in zip(votes, caps)]
    seats = min(seats, sum(caps))

    def dealt(divisor: float) -> list[int]:
        return [min(c, int(v / divisor + 0.5)) for v, c in zip(votes, caps)]

    if seats <= 0:
        return [0] * len(votes)
    # A divisor that deals no seat too many; the few that are left go one by one.
    low, high = 0.0, 4.0 * max(votes)
    for _ in range(100):
        middle = (low + high) / 2
        if middle > 0 and sum(dealt(middle)) <= seats:
            high = middle
        else:
            low = middle
    out = dealt(high)
    heap = [(-v / (2 * s + 1), i) for i, (v, s, c) in enumerate(zip(votes, out, caps)) if s < c]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def _quota_plan(rows: pd.DataFrame) -> pd.DataFrame:
    """The blocks of one source and the rest of its quota, dealt to its shards."""
    rows = rows.sort_values("shard")
    words = rows.line.tolist()
    blocks = [max(1, b) for b in sainte_lague(words, int(rows.blocks.iloc[0]), words)]
    return rows.assign(blocks=blocks, seats=sainte_lague(words, int(rows.seats.iloc[0]), blocks))


def marked_blocks(sid: int, shard: int, line: int, blocks: int, seats: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks of a line are taken once more, and the words of such blocks ahead of each; one entry more than blocks."""
    key = (sid * 0x9E3779B97F4A7C15 + shard * 0xC2B2AE3D27D4EB4F + seed * 0xD6E8FEB86659FD93) & (2**64 - 1)
    x = np.arange(1, blocks + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    marks = np.zeros(blocks + 1, np.int64)
    marks[np.lexsort((np.arange(blocks), x))[:seats]] = 1
    ends = np.arange(blocks + 1) * line // blocks
    return marks, np.concatenate([[0], np.cumsum(marks[:-1] * np.diff(ends))])


def _with_marks(lines: DataFrame, seed: int) -> DataFrame:
    @F.pandas_udf("marks array<long>, before array<long>")
    def marked(sid: pd.Series, shard: pd.Series, line: pd.Series, blocks: pd.Series, seats: pd.Series) -> pd.DataFrame:
        rows = [marked_blocks(*map(int, r), seed) for r in zip(sid, shard, line, blocks, seats)]
        return pd.DataFrame({"marks": [m for m, _ in rows], "before": [b for _, b in rows]})

    return lines.withColumn("of", marked("sid", "shard", "line", "blocks", "seats")).select(
        "sid", "shard", "line", "blocks", F.col("passes").alias("base"), "of.marks", "of.before"
    )


def _targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``targets`` on a frame ``(source, source_size, weight)``, with the same rounds; a round is one sum over the sources."""
    capped = F.col("source_size") * F.lit(float(most))
    words, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    unit, full = (share * words / weights if weights else 0.0), -1
    while True:
        above = capped < F.col("weight") * F.lit(unit)
        held, open_, number = sources.agg(
            F.coalesce(F.sum(F.when(above, capped)), F.lit(0.0)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if number == full or not open_:
            return sources.withColumn("target", F.when(above, capped).otherwise(F.col("weight") * F.lit(unit)) if open_ else capped)
        unit, full = (share * words - held) / open_, number


def _sources(base: DataFrame, weights: Sequence[float], share: float) -> DataFrame:
    """A row per source: number, words, target, blocks, passes over all of it, seats beyond them, and shards."""
    sums = staged(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), "sources")
    listed = running(sums, [F.col("source").asc_nulls_last()]).withColumn("sid", (F.col("rank") - 1).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    goals = staged(_targets(staged(listed.select("sid", "source", "source_size", "docs", weight.alias("weight")), "weights"), share, MOST), "targets")
    total = goals.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    block = max(1.0, min(total / SEATS, float(BLOCK_WORDS)))
    finer = F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.try_divide(F.lit(LEAST_SEATS * block), F.col("target"))))))
    width = F.greatest(F.lit(1.0), F.lit(block) / finer)
    filled = (F.col("source_size") > 0) & (F.col("target") > 0)
    blocks = F.when(filled, F.least(F.col("source_size"), F.ceil(F.col("source_size") / width))).otherwise(1)
    shards = F.greatest(
        F.lit(1), F.ceil(F.col("blocks") / SHARD_BLOCKS),
        F.least(F.ceil(F.col("docs") / SHARD_DOCS), F.floor(F.col("blocks") / FEW_BLOCKS)),
    )
    quota = F.when(filled, F.floor(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size")) + 0.5)).otherwise(0)
    return goals.withColumn("blocks", blocks.cast("long")).withColumn("quota", quota.cast("long")).select(
        "sid", F.col("source").alias("name"), "source_size", "target", "blocks", shards.cast("int").alias("shards"),
        F.expr("quota div blocks").alias("passes"), F.expr("quota % blocks").alias("seats"),
    )


def _extra_words(place: str):
    """Words of once more taken blocks before ``place`` on the shard's line."""
    block = f"(least(({place} + 1) * blocks - 1, blocks * line) div greatest(line, 1))"
    return F.expr(f"get(before, int({block})) + get(marks, int({block})) * ({place} - ({block} * line) div blocks)")


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: what the mix takes of it.

    Columns: id, ``mix_source``, ``mark`` (``xxhash64`` of the text), ``copy`` (counts rows of one source,
    id and text from 1; 0 for documents without a word), ``size`` (words; 0 for a null text), ``source_size``,
    ``target`` of its source, ``taken`` (words taken, repeats counted, at most twice the size), ``start``
    (place on the shard's line) and the shard's ``line``, ``blocks``, ``base``, ``marks``, ``before``.

    Sources are ordered by code point, null last as a source of its own, and get the
    weights in turn. Reruns agree: every choice depends on ids, texts and the seed alone.
    Repeated rows are documents of their own. An empty table gives no rows, a source
    without words gets nothing.
    """
    plain_unions(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    base = durable(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), words.alias("size"), F.xxhash64(text).alias("mark"),
    ))
    listed = _sources(base, weights, share)
    shard = F.pmod(F.xxhash64("id", "mark", F.lit(seed)), F.col("shards")).cast("int")
    named = base.join(listed, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    placed = named.where("size > 0").withColumn("shard", shard)
    lines = durable(placed.groupBy("sid", "shard").agg(
        F.sum("size").alias("line"), *[F.first(c).alias(c) for c in ("shards", "blocks", "passes", "seats")]
    ))
    several = lines.where("shards > 1").groupBy("sid").applyInPandas(_quota_plan, lines.schema)
    plan = durable(_with_marks(lines.where("shards = 1").unionByName(several), seed))
    order = Window.partitionBy("sid", "shard").orderBy(F.xxhash64("id", "mark", F.lit(seed + 1)), "id", "mark", "size")
    rows = placed.withColumns({
        "end": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "copy": F.row_number().over(Window.partitionBy("sid", "shard", "id", "mark").orderBy("size")),
    }).withColumn("start", F.col("end") - F.col("size"))
    rows = rows.join(plan.withColumnRenamed("blocks", "cuts"), ["sid", "shard"]).drop("blocks").withColumnRenamed("cuts", "blocks")
    taken = F.col("base") * F.col("size") + _extra_words("end") - _extra_words("start")
    columns = ["source_size", "target"]
    out = rows.select(
        F.col("id").alias(id_col), "mark", "copy", F.col("source").alias("mix_source"), "size", *columns,
        taken.cast("long").alias("taken"), "start", "line", "blocks", "base", "marks", "before",
    )
    none, nothing = F.lit(0).cast("long"), F.array().cast("array<long>")
    empty = named.where("size = 0").select(
        F.col("id").alias(id_col), "mark", F.lit(0).alias("copy"), F.col("source").alias("mix_source"), "size", *columns,
        *[none.alias(c) for c in ("taken", "start", "line", "blocks", "base")], nothing.alias("marks"), nothing.alias("before"),
    )
    return out.unionByName(empty)


def taken_spans(start: int, size: int, line: int, blocks: int, base: int, marks: Sequence[int]) -> list[tuple[int, int]]:
    """The word spans to take of a document: whole ``base`` times, then each run of once more taken blocks."""
    spans = [(0, size)] * base
    if not size or not any(marks):
        return spans if size else []
    end, j = start + size, ((start + 1) * blocks - 1) // line
    while j < blocks and j * line // blocks < end:
        if marks[j]:
            a, b = max(start, j * line // blocks) - start, min(end, (j + 1) * line // blocks) - start
            if len(spans) > base and spans[-1][1] == a:
                spans[-1] = (spans[-1][0], b)
            elif a < b:
                spans.append((a, b))
        j += 1
    return spans


def cut_words(text: str, span: tuple[int, int], size: int) -> str:
    """The words of a span with the white space between them; the text itself for all words."""
    if span == (0, size):
        return text
    data, words = text.encode(), []
    at = 0
    for word in data.split()[: span[1]]:
        at = data.index(word, at)
        words.append((at, at + len(word)))
        at += len(word)
    return data[words[span[0]][0] : words[-1][1]].decode()


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents of the mix: a row for each time that a document or a part of it is taken.

    The result has the columns of ``docs``, whatever their names; only the text is cut.
    """

    @F.pandas_udf("array<struct<first: int, last: int>>")
    def spans(start: pd.Series, size: pd.Series, line: pd.Series, blocks: pd.Series, base: pd.Series, marks: pd.Series) -> pd.Series:
        rows = zip(start, size, line, blocks, base, marks)
        return pd.Series([[{"first": a, "last": b} for a, b in taken_spans(*map(int, r[:5]), r[5])] for r in rows], dtype=object)

    @F.pandas_udf("array<string>")
    def texts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, size, spans in batches:
            yield pd.Series([[cut_words(t, (s["first"], s["last"]), n) for s in p] for t, n, p in zip(text, size, spans)], dtype=object)
        give_back()

    id_, source, text = (F.col(f"`{c}`") for c in (id_col, source_col, text_col))
    # The blocks of a shard stay with the plan; what travels to the texts is the spans of each document.
    plan = mix_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how).where("taken > 0").select(
        F.col(id_col).alias("plan_id"), "mix_source", "mark", "copy", "size",
        spans("start", "size", "line", "blocks", "base", "marks").alias("spans"),
    )
    names = {c: spare(docs, c) for c in (*plan.columns, "number", "cut")}
    plan = plan.select(*[F.col(c).alias(names[c]) for c in plan.columns])
    number = F.row_number().over(Window.partitionBy(id_, source, F.xxhash64(text)).orderBy(F.length(text)))
    both = docs.withColumn(names["number"], number).join(
        plan,
        id_.eqNullSafe(F.col(names["plan_id"])) & source.eqNullSafe(F.col(names["mix_source"]))
        & (F.xxhash64(text) == F.col(names["mark"])) & (F.col(names["number"]) == F.col(names["copy"])),
    )
    small_batches(docs.sparkSession)
    taken = both.withColumn(names["cut"], F.explode(texts(text, names["size"], names["spans"])))
    return taken.select(*[F.col(names["cut"]).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
