"""Language-model scoring by deleted interpolation (operator 1).

P1(w) = (count(w) + 1) / (N + V + 1)
P2(w | v) = l2(b) * count(v w) / count(v) + (1 - l2(b)) * P1(w)
P3(w | u v) = l3(b) * count(u v w) / count(u v) + (1 - l3(b)) * P2(w | v)

and so on up to `order`, over words and an end after each text; before a text stand starts. b is the
bucket of the context's frequency, by powers of two; a context never seen has weight 0. The weights come
from expectation-maximisation on training texts whose own counts are deleted from the model for that (the
tuning part): those of l2 first, those of l3 over the P2 so found, and so on. Scoring then uses the counts of
all training texts.

How it runs. Texts are cut into blocks of some megabytes. A block counts its distinct n-grams and
sends them, as sorted packed hashes, one cell for each range of hashes; so a frequent n-gram
travels once for each block and not for each of its places. Words and pairs are counted first, then each
longer order by itself, so that only one order's cells lie on disk at a time. Each range adds up its cells and
answers every cell with the totals, in the cell's own order. The answers meet the block's texts
again, and each text gets its lists of counts, from which EM and scores are scans. What is sent
grows with the corpus; a range or a block keeps its size. N-grams are compared by 64-bit hashes.

The texts are read several times and must come in the same blocks each time. A table of files does so;
with `fixed=False` the texts are written to the scratch folder first. Each answer is checked
against the block's n-grams, and a difference stops the job.

Very long texts are blocks of their own. Columns beside id and text are left out, whatever their names.
Null and empty texts consist of the end alone. A null id counts as empty text for the split.
Repeated rows are texts of their own. Without training texts all counts are 0 and the score is
that of the uniform base; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch, id_type, ship, texts
from tallystar.llm.text import NOT_SPACE, Texts, U, chunks, mix, span_hashes, words

#: Bytes of text in a block, and of text for each range of hashes.
BLOCK = 4 << 20
RANGE = 12 << 20

_END = U(0x7C15B0A5D00D1E55)
_START = U(0x1B873593CC9E2D51)
#: Steps of an octave in which ratios of the two estimates are told apart for EM. The histogram that comes
#: to the driver has at most BUCKETS times some 2**14 rows, whatever the corpus.
STEPS = 256
BUCKETS = 64
#: Tasks of a shuffle beyond which each takes more pieces, one after another.
MOST_TASKS = 1 << 15


def _pack(values: np.ndarray, squeeze: bool = False) -> bytes:
    """64-bit numbers as planes of bytes, without the high planes that are all zeros."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 0
    data = bytes([used]) + np.ascontiguousarray(planes[:used]).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(data) if squeeze else data


def _unpack(data: bytes, squeezed: bool = False) -> np.ndarray:
    if squeezed:
        data = zstandard.ZstdDecompressor().decompress(data)
    used = data[0] if data else 0
    if not used:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(used, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :used] = planes.T
    return out.view("<u8").ravel().astype(np.uint64, copy=False)


def _grams(texts_: Texts, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of words and ends, of (previous, this) pairs and so on, and each text's bounds."""
    found = words(texts_, NOT_SPACE)
    n = len(texts_)
    bounds = found.bounds + np.arange(n + 1)
    token = np.empty(bounds[-1], np.uint64)
    ends = bounds[1:] - 1
    inside = np.ones(len(token), bool)
    inside[ends] = False
    token[inside] = span_hashes(texts_, found.start, found.end, lower=True)
    token[ends] = _END
    place = np.arange(len(token)) - np.repeat(bounds[:-1], np.diff(bounds))
    grams = [token]
    for back in range(1, order):
        before = np.full_like(token, _START)
        inner = np.flatnonzero(place >= back)
        before[inner] = token[inner - back]
        grams.append(mix(before + mix(grams[-1] + U(back))))
    return grams, bounds


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """First place of each range in sorted keys."""
    part = ((keys >> U(40)) * U(ranges)) >> U(24)
    return np.searchsorted(part, np.arange(ranges + 1))


def _block_name(task: int, number: int) -> int:
    return (task << 24) | number


def _roles(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("part").to_numpy(zero_copy_only=False)


def _cells(ranges: int, held: int, tuning: int, orders: tuple[int, ...]):
    """(block, range, order, keys, main, tuned): counts of the block's distinct n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, (batch, texts_) in enumerate(chunks(batches, size=BLOCK)):
            grams, bounds = _grams(texts_, orders[-1])
            role = np.repeat(_roles(batch), np.diff(bounds))
            main, tuned = (role != held) & (role != tuning), role == tuning
            rows = {name: [] for name in _CELL.names}
            for order in orders:
                keys, which = np.unique(grams[order - 1], return_inverse=True)
                counts = [np.bincount(which[m], minlength=len(keys)) for m in (main, tuned)]
                cuts = _ranges(keys, ranges)
                for r in range(ranges):
                    a, b = cuts[r], cuts[r + 1]
                    if a == b:
                        continue
                    rows["block"].append(_block_name(task, number))
                    rows["range"].append(r)
                    rows["order"].append(order)
                    rows["keys"].append(_pack(np.diff(keys[a:b], prepend=U(0))))
                    rows["main"].append(_pack(counts[0][a:b], True))
                    rows["tuned"].append(_pack(counts[1][a:b], True))
            yield pa.record_batch(rows, schema=_CELL)

    return run


_CELL = pa.schema(
    [
        ("block", pa.int64()),
        ("range", pa.int32()),
        ("order", pa.int32()),
        ("keys", pa.binary()),
        ("main", pa.binary()),
        ("tuned", pa.binary()),
    ]
)
_ANSWER = pa.schema(
    [
        ("block", pa.int64()),
        ("range", pa.int32()),
        ("order", pa.int32()),
        ("mark", pa.int64()),
        ("main", pa.binary()),
        ("total", pa.binary()),
        ("tokens", pa.int64()),
        ("kinds", pa.int64()),
    ]
)


def _mark(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mix(keys)).astype(np.int64)) if len(keys) else 0


def _answers(table: pa.Table) -> pa.Table:
    """Totals over all cells of a range and kind, for each cell in its order."""
    table = table.combine_chunks()
    cells = [np.cumsum(_unpack(x.as_py())) for x in table["keys"]]
    keys, which = np.unique(np.concatenate(cells), return_inverse=True)
    sums = [
        np.bincount(
            which, np.concatenate([_unpack(x.as_py(), True) for x in table[c]]), minlength=len(keys)
        ).astype(np.uint64)
        for c in ("main", "tuned")
    ]
    total = sums[0] + sums[1]
    cuts = np.concatenate([[0], np.cumsum([len(c) for c in cells])])
    parts = [which[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    first = np.arange(len(cells)) == 0  # the sums of the range go with its first cell
    return pa.table(
        {
            "block": table["block"],
            "range": table["range"],
            "order": table["order"],
            "mark": [_mark(c) for c in cells],
            "main": [_pack(sums[0][p], True) for p in parts],
            "total": [_pack(total[p], True) for p in parts],
            "tokens": np.where(first, int(total.sum()), 0),
            "kinds": np.where(first, int((total > 0).sum()), 0),
        },
        schema=_ANSWER,
    )


def _packed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, data): the rows of each block, cut as in _cells, as one compressed value."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    for number, (batch, _) in enumerate(chunks(batches, size=BLOCK)):
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
            writer.write_batch(batch)
        yield pa.record_batch(
            {
                "block": pa.array([_block_name(task, number)], pa.int64()),
                "data": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            }
        )


def _parts(
    batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `size` bytes in a binary column."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            limit = size + (ends[first - 1] if first else 0)
            last = max(first + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def _counted(tuning: int, order: int):
    """Counts of the n-grams that end at each token of a text, from a block's texts and answers."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if blocks.num_rows != 1:
            raise ValueError("the blocks of texts changed between reads")
        table = pa.ipc.open_stream(blocks["data"][0].as_py()).read_all()
        [batch] = table.combine_chunks().to_batches()
        [(batch, texts_)] = chunks(iter([batch]), size=1 << 62)
        grams, bounds = _grams(texts_, order)
        kind, at = answers["order"].to_numpy(), answers["range"].to_numpy()
        is_tuned = _roles(batch) == tuning
        out = {"doc_id": batch.column("doc_id"), "part": batch.column("part")}
        for n, own_grams in enumerate(grams, 1):
            keys, which = np.unique(own_grams, return_inverse=True)
            own = np.flatnonzero(kind == n)
            own = own[np.argsort(at[own])].tolist()
            mark = np.bitwise_xor.reduce(
                np.array([answers["mark"][i].as_py() for i in own], np.int64)
            )
            for column in ("main", "total"):
                values = np.concatenate([_unpack(answers[column][i].as_py(), True) for i in own])
                if len(values) != len(keys) or int(mark) != _mark(keys):
                    raise ValueError("the blocks of texts changed between reads")
                # Counts without the tuning part are wanted for its own texts only.
                wanted = is_tuned if column == "main" else np.ones(len(is_tuned), bool)
                found = values[which] if wanted.any() else values
                packed = [
                    _pack(found[a:b]) if w else b""
                    for a, b, w in zip(bounds[:-1], bounds[1:], wanted, strict=True)
                ]
                out[f"{column}{n}"] = pa.array(packed, pa.binary())
        return pa.table(out)

    return run


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a packed column, and the bounds of its rows."""
    rows = [_unpack(x.as_py()) for x in column]
    return (
        np.concatenate([np.zeros(0, np.uint64), *rows]).astype(np.float64),
        np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64),
    )


class _Model:
    """The mixture: counts that do not depend on a text, and the weights of the orders from 2 on."""

    def __init__(self, texts_count: int, base_size: int, weights: list[np.ndarray]) -> None:
        self.texts_count, self.base_size, self.weights = texts_count, base_size, weights

    def level(self, contexts: np.ndarray, counts: np.ndarray, bounds: np.ndarray):
        """Bucket of each context, and likelihood of the n-gram given it."""
        context = np.empty(len(counts))
        context[1:] = contexts[:-1]
        context[bounds[:-1]] = self.texts_count
        return np.log2(context + 1).astype(np.int64), counts / np.maximum(context, 1)

    def estimate(self, counts: list[np.ndarray], bounds: np.ndarray):
        """P1 of each token, and its estimate by all orders that have weights."""
        base = estimate = (counts[0] + 1) / self.base_size
        for weight, contexts, own in zip(self.weights, counts, counts[1:]):
            bucket, high = self.level(contexts, own, bounds)
            estimate = weight[bucket] * high + (1 - weight[bucket]) * estimate
        return base, estimate


def _ratios(model: _Model, order: int):
    """(bucket, step, n): how often the estimate of `order` is 2**(step/STEPS) times the lower ones'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in _parts(batches, "main1"):
            counts = [_joined(batch.column(f"main{n}")) for n in range(1, order + 1)]
            bounds = counts[0][1]
            counts = [c for c, _ in counts]
            _, low = model.estimate(counts[:-1], bounds)
            bucket, high = model.level(counts[-2], counts[-1], bounds)
            known = bucket > 0  # contexts that the model has not seen have no weight
            step = np.full(len(high), -(1 << 15))
            seen = high > 0
            step[seen] = np.round(np.log2(high[seen] / low[seen]) * STEPS)
            key, many = np.unique(bucket[known] * (1 << 17) + step[known] + (1 << 16), return_counts=True)
            for k, m in zip(key.tolist(), many.tolist(), strict=True):
                total[k] = total.get(k, 0) + m
        keys = np.fromiter(total, np.int64, len(total))
        yield pa.record_batch(
            {
                "bucket": pa.array(keys >> 17, pa.int32()),
                "step": pa.array((keys & ((1 << 17) - 1)) - (1 << 16), pa.int32()),
                "n": pa.array(list(total.values()), pa.int64()),
            }
        )

    return run


def learned_weights(
    bucket: np.ndarray, step: np.ndarray, n: np.ndarray, rounds: int = 200
) -> np.ndarray:
    """Weight of the longer n-gram's estimate in each bucket, by EM. Unseen buckets have weight 0."""
    ratio = np.where(step == -(1 << 15), 0.0, 2.0 ** (step / STEPS))
    size = np.bincount(bucket, n, minlength=BUCKETS)
    weight = np.where(size > 0, 0.5, 0.0)
    for _ in range(rounds):
        w = weight[bucket]
        share = n * w * ratio / (w * ratio + 1 - w + 1e-300)
        new = np.bincount(bucket, share, minlength=BUCKETS) / np.maximum(size, 1)
        new = np.minimum(new, 1 - 1e-6)  # some mass for what was never seen
        done = np.abs(new - weight).max() < 1e-9
        weight = new
        if done:
            break
    return weight


def _scores(model: _Model, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "total1"):
            counts = [_joined(batch.column(f"total{n}")) for n in range(1, order + 1)]
            bounds = counts[0][1]
            counts = [c for c, _ in counts]
            base, estimate = model.estimate(counts, bounds)
            first = bounds[:-1]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": batch.column("part"),
                    "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                    "n_known": pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), first)),
                    "base_score": np.add.reduceat(np.log10(base), first),
                    "score": np.add.reduceat(np.log10(estimate), first),
                }
            )

    return run


def _tasks(pieces: int, each: int) -> int:
    """Tasks of `each` pieces; so many that a task keeps its size as the corpus grows."""
    return min(max(16, -(-pieces // each)), MOST_TASKS)


def interpolated_scores(
    docs: DataFrame,
    modulus: int = 7,
    held: int = 2,
    tuning: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    fixed: bool = False,
    order: int = 3,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, train_kinds.

    A text's part is crc32 of its id, as text, modulo `modulus`: `held` texts are scored only,
    `tuning` texts learn the weights, all but the held ones are counted. `order` is 2 or more.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    own = texts(docs, id_col, text_col).withColumn(
        "part",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus)
        .cast("int"),
    )
    if not fixed:
        own = scratch.saved(own, "texts")
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(16, -(-size // RANGE))
    answers = None
    for orders in [(1, 2), *[(n,) for n in range(3, order + 1)]]:
        cells = own.mapInArrow(
            _cells(ranges, held, tuning, orders),
            "block long, range int, order int, keys binary, main binary, tuned binary",
        ).repartition(_tasks(ranges, 2), "order", "range")
        added = scratch.saved(
            cells.groupBy("order", "range").applyInArrow(
                _answers,
                "block long, range int, order int, mark long, main binary, total binary, "
                "tokens long, kinds long",
            ),
            f"answers{orders[-1]}",
        )
        answers = added if answers is None else answers.unionByName(added)
    train, kinds = answers.where("order = 1").agg(F.sum("tokens"), F.sum("kinds")).first()
    train, kinds = train or 0, kinds or 0
    texts_all, texts_main = (
        own.where(F.col("part") != held)
        .agg(F.count("*"), F.count(F.when(F.col("part") != tuning, 1)))
        .first()
    )
    tasks = _tasks(-(-size // BLOCK), 2)
    blocks = own.mapInArrow(_packed_blocks, "block long, data binary").repartition(tasks, "block")
    answers = answers.select("block", "range", "order", "mark", "main", "total")
    kinds_of_counts = ", ".join(f"main{n} binary, total{n} binary" for n in range(1, order + 1))
    kind = id_type(docs, id_col).simpleString()
    counted = scratch.saved(
        blocks.groupBy("block")
        .cogroup(answers.repartition(tasks, "block").groupBy("block"))
        .applyInArrow(_counted(tuning, order), f"doc_id {kind}, part int, {kinds_of_counts}"),
        "counted",
    )
    base_size, weights = train + kinds + 1, []
    for n in range(2, order + 1):
        main = [f"main{k}" for k in range(1, n + 1)]
        ratios = (
            counted.where(F.col("part") == tuning).select(*main)
            .mapInArrow(_ratios(_Model(texts_main, base_size, weights), n), "bucket int, step int, n long")
            .groupBy("bucket", "step").agg(F.sum("n").alias("n"))
            .orderBy("bucket", "step").toArrow()
        )
        found = (ratios[c].to_numpy().astype(np.int64) for c in ("bucket", "step", "n"))
        weights = [*weights, learned_weights(*found)]
    scored = counted.select("doc_id", "part", *[f"total{n}" for n in range(1, order + 1)]).mapInArrow(
        _scores(_Model(texts_all, base_size, weights), order),
        f"doc_id {kind}, part int, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.select(
        "doc_id",
        (F.col("part") == held).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.lit(kinds).cast("long").alias("train_kinds"),
    )
