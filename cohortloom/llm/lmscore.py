"""Language-model scoring by cross-entropy difference of two n-gram models over one vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import steps, stored, texts_of

#: Order of the models, and bits of a token: 0 is the border of a text, the others are all code
#: points, each by one more than its number. Two tokens make a pair, two pairs an n-gram.
ORDER, BITS = 4, 21
SIZE = 1 << BITS
#: Texts are counted and scored by blocks of about so many bytes, each with its own n-grams.
BLOCK_BYTES = 8 << 20


def _points(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts in a row, and how many each text has."""
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    counts = np.fromiter(map(len, lowered), np.int64, len(lowered))
    return np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32), counts


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last pair of each different n-gram, the n-gram that ends at each token, text by
    text, and the tokens of each text.

    Each text ends with a border; borders also stand before it, so every token has a full context.
    """
    points, counts = _points(texts)
    sizes, turn = counts + 1, np.arange(len(counts))
    tokens = np.zeros(int(counts.sum()) + ORDER * len(counts), np.int64)
    tokens[np.arange(len(points)) + np.repeat(ORDER * turn + ORDER - 1, counts)] = points.astype(np.int64) + 1
    pairs = pa.array(tokens[:-1] << BITS | tokens[1:]).dictionary_encode()
    ids, values = pairs.indices.to_numpy().astype(np.int64), pairs.dictionary.to_numpy()
    ends = np.arange(int(sizes.sum())) + np.repeat((ORDER - 1) * (turn + 1), sizes)
    grams = pa.array(ids[ends - 3] << 32 | ids[ends - 1]).dictionary_encode()
    kinds = grams.dictionary.to_numpy()
    return values[kinds >> 32], values[kinds & 0xFFFFFFFF], grams.indices.to_numpy(), sizes


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``block``, dealt by their hash to as many blocks as their texts ask for."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64(*rows.columns), F.lit(size // BLOCK_BYTES + 1))
    return rows.select(block.alias("block"), *rows.columns).repartition("block")


def counts(blocks: DataFrame) -> DataFrame:
    """``block``, ``head``, ``tail`` and ``n`` of every n-gram of each block; nothing is left out."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        parts = []
        for batch in steps(rows.to_batches()):
            head, tail, at, _ = _grams(texts_of(batch))
            parts.append(pa.table({"head": head, "tail": tail, "n": np.bincount(at, minlength=len(head))}))
        total = pa.concat_tables(parts).group_by(["head", "tail"]).aggregate([("n", "sum")])
        block = pa.array(np.full(total.num_rows, key[0].as_py(), np.int64))
        return pa.table([block, total["head"], total["tail"], total["n_sum"]], ["block", "head", "tail", "n"])

    return blocks.groupBy("block").applyInArrow(run, "block bigint, head bigint, tail bigint, n bigint")


MODELS = ("target", "background")


def losses(counted: DataFrame) -> DataFrame:
    """``head``, ``tail`` and, for both models, the loss (bits) of the last token given those before.

    ``counted`` has a row for each n-gram with its counts in the columns of ``MODELS``. Witten-Bell:
    a context keeps as much for the shorter context as it has had different successors; the shortest
    falls back to equal chances of all ``SIZE`` tokens. Every order is a table of its own.
    """
    token, pair = F.lit(SIZE - 1), F.lit((1 << 2 * BITS) - 1)
    three = F.shiftleft(F.col("head").bitwiseAND(token), 2 * BITS).bitwiseOR(F.col("tail"))

    def mixed(total: dict[str, Column], kinds: dict[str, Column], below: dict[str, Column]) -> dict[str, Column]:
        own = {m: (F.col(m) + kinds[m] * below[m]) / (total[m] + kinds[m]) for m in MODELS}
        return {f"{m}_chance": F.when(total[m] > 0, own[m]).otherwise(below[m]) for m in MODELS}

    def level(rows: DataFrame, context: list[Column], last: Column, shorter: DataFrame) -> DataFrame:
        """Chances of ``rows`` from those of the shorter n-grams that they end with."""
        after = Window.partitionBy(*context)
        below = shorter.select(F.col("gram").alias("_last"), *[F.col(f"{m}_chance").alias(f"_{m}") for m in MODELS])
        # A hint keeps the plan of a small corpus that of a large one.
        joined = rows.withColumn("_last", last).join(below.hint("shuffle_hash"), "_last")
        total = {m: F.sum(m).over(after) for m in MODELS}
        kinds = {m: F.sum((F.col(m) > 0).cast("bigint")).over(after) for m in MODELS}
        return joined.withColumns(mixed(total, kinds, {m: F.col(f"_{m}") for m in MODELS}))

    def ending(gram: Column) -> DataFrame:
        return counted.groupBy(gram.alias("gram")).agg(*[F.sum(m).alias(m) for m in MODELS])

    single = ending(F.col("tail").bitwiseAND(token))
    sums = single.agg(*[f(m) for m in MODELS for f in (lambda m: F.sum(m).alias(f"_{m}"), lambda m: F.count_if(F.col(m) > 0).alias(f"_{m}_kinds"))])
    total, kinds = ({m: F.col(f"_{m}{x}") for m in MODELS} for x in ("", "_kinds"))
    chances = single.crossJoin(F.broadcast(sums)).withColumns(mixed(total, kinds, {m: F.lit(1 / SIZE) for m in MODELS}))
    chances = level(ending(F.col("tail")), [F.shiftright("gram", BITS)], F.col("gram").bitwiseAND(token), chances)
    chances = level(ending(three), [F.shiftright("gram", BITS)], F.col("gram").bitwiseAND(pair), chances)
    chances = level(counted, [F.col("head"), F.shiftright("tail", BITS)], three, chances)
    return chances.select("head", "tail", *[(-F.log2(f"{m}_chance")).cast("float").alias(f"{m}_loss") for m in MODELS])


def scored(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``target_loss``, ``background_loss``, ``score`` of every row.

    The background model counts all of ``docs``, the target model the texts of ``target`` (column
    ``text``; others are ignored but deal out the rows). Both have the same order, smoothing and
    vocabulary: all lower-case characters. A document's losses are means over its tokens (its
    characters and its end), its score is what the target model saves for each token: background
    less target loss. NULL texts count as empty and have one token, the end. An empty target has the
    uniform model. Rows keep their number and keys, NULL or repeated; other columns are ignored.

    Models are tables that grow with the corpus: a block of texts is joined with the losses of its
    own n-grams, and no task or driver holds the whole model.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    blocks = _blocks(picked)
    asked = stored(counts(blocks), "ngrams")
    wanted = counts(_blocks(target.withColumn("text", F.col("text").cast("string"))))
    zero = F.lit(0).cast("bigint")
    both = asked.select("head", "tail", zero.alias("target"), F.col("n").alias("background"))
    both = both.unionByName(wanted.select("head", "tail", F.col("n").alias("target"), zero.alias("background")))
    counted = stored(both.groupBy("head", "tail").agg(*[F.sum(m).alias(m) for m in MODELS]), "model")
    model = stored(losses(counted), "losses")
    known = asked.select("block", "head", "tail").join(model.hint("shuffle_hash"), ["head", "tail"])
    names = ["key", "n_tokens", "target_loss", "background_loss", "score"]

    def run(texts: pa.Table, grams: pa.Table) -> pa.Table:
        first, last = (pc.unique(grams[c].combine_chunks()) for c in ("head", "tail"))

        def codes(head: pa.Array, tail: pa.Array) -> pa.Array:
            a, b = (pc.index_in(x, value_set=v).to_numpy(zero_copy_only=False) for x, v in ((head, first), (tail, last)))
            return pa.array(a.astype(np.int64) << 32 | b.astype(np.int64))

        all_codes = codes(grams["head"].combine_chunks(), grams["tail"].combine_chunks())
        loss = [grams[f"{m}_loss"].to_numpy().astype(np.float64) for m in MODELS]
        parts = []
        for batch in steps(texts.to_batches()):
            head, tail, at, sizes = _grams(texts_of(batch))
            place = pc.index_in(codes(pa.array(head), pa.array(tail)), value_set=all_codes).to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            means = [np.add.reduceat(x[place][at], starts) / sizes for x in loss]
            columns = [sizes, *means, means[1] - means[0]]
            parts.append(pa.table([batch.column("key"), *map(pa.array, columns)], names))
        return pa.concat_tables(parts)

    schema = f"key {kind}, n_tokens bigint, target_loss double, background_loss double, score double"
    done = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)
    return done.withColumnRenamed("key", key)


def labelled_target(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``text`` of the rows of ``docs`` whose quality label is 1: the target corpus.

    The texts are shuffled at every size, so the plan of a small corpus is that of a large one.
    """
    good = labels.filter("quality = 1").select(F.col(key).alias("_key")).distinct()
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(good.hint("shuffle_hash"), "_key")
