"""Scores of texts under a self-attention language model trained on the corpus, beside a unigram base.

The text is seen as its words, lower-cased (A-Z): one space before each word, then an end. The model works on byte-level
subword ids of that line. What it learns covers all training documents: word counts, subword counts, what precedes each
subword, class bigrams, and attention weights. The weights come from rounds of local training: each task passes once over
every window of its documents, and the tasks' weights are averaged by their windows, in two steps, before the next round.
So the weights, unlike the counts, depend a little on how rows lie in partitions. Held-out documents teach nothing.

Work goes in steps of bounded numbers of ids, unless a single text is longer. Counts leave a task as a few packed blocks.

The base needs a count for every word. The most frequent words (``hot_words`` at most) are broadcast; each other word of
a document becomes a row that joins the counts by word. So no worker holds the vocabulary.

Defined results: null text is empty: one end token; a null id is hashed as the empty string; repeated rows are scored
each; an empty table gives no rows; with no training documents all counts are zero and the base divides by one; other
columns are ignored. Texts are scored whole, whatever their length.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import attention_lm as lm
from .common import arrow_type, id_and_text, map_lists, rested, stored, text_batches

#: GPT-like pre-tokens of a line of words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CLASSES, SHARED, KINDS = 1024, 32, 32
END = b" "  # no word holds a space
#: Cells of a vector of counts that travel in one row, and bytes of ids that a step takes.
BLOCK, STEP_BYTES = 1 << 16, 1_000_000

#: White space that words may hold. Next to it, what a word's subwords are may depend on its neighbours.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_coders: dict = {}
_spelled: dict = {}


def _coder(path: str):
    if path not in _coders:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _coders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _coders[path]


def _pieces(path: str) -> pa.Array:
    """The bytes of each id."""
    if path not in _spelled:
        with open(path, "rb") as file:
            ranks = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, file))
        _spelled[path] = pa.array([x for _, x in ranks], pa.binary())
    return _spelled[path]


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def _words(lines: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of lines, the words as numbers of these, and how many each line has."""
    parts = pc.split_pattern(lines, b" ")  # the first part of each line is empty
    sizes = np.diff(parts.offsets.to_numpy())
    flat = parts.flatten().dictionary_encode()
    codes = flat.indices.to_numpy()
    if not len(codes):
        return flat.dictionary, codes, sizes
    first = np.zeros(len(codes), np.bool_)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    return flat.dictionary, codes[~first], np.maximum(sizes - 1, 0)


def _ids(line: bytes, path: str) -> np.ndarray:
    return _coder(path).encode_to_numpy(line.decode("utf-8", "replace"), disallowed_special=()).astype("<u2")


def packed(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text's line. Each distinct word is encoded once, after a space, and its ids are put where it stands."""
    lines = [b" " + b" ".join(w) if (w := words(t)) else b"" for t in texts]
    names, codes, sizes = _words(pa.array(lines, pa.binary()))
    if not len(codes):
        return [b""] * len(texts)
    filled = pc.binary_length(names).to_numpy() > 0  # what is before a line's first space is empty
    names, codes = names.filter(pa.array(filled)), (np.cumsum(filled) - 1)[codes]
    long = pc.binary_length(names).to_numpy()
    whole = np.full(len(names) + long.sum(), 32, np.uint8)
    starts = np.cumsum(long + 1) - long - 1
    within = np.ones(len(whole), np.bool_)
    within[starts] = False
    places = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + len(names) + 1]
    whole[within] = np.frombuffer(names.buffers()[2], np.uint8)[places[0] : places[-1]]
    line = whole.tobytes().decode("utf-8", "replace")
    whole = np.frombuffer(line.encode(), np.uint8)  # the same but for surrogates
    ids = _ids(line.encode(), path)
    # a word's ids end where its bytes do
    bytes_to = np.cumsum(pc.binary_length(_pieces(path)).to_numpy()[ids])
    ends = np.searchsorted(bytes_to, np.append(np.flatnonzero(whole == 32)[1:], len(whole))) + 1
    first, many = np.concatenate([[0], ends[:-1]])[codes], np.diff(ends, prepend=0)[codes]
    to = np.cumsum(many)
    flat = ids[np.repeat(first - to + many, many) + np.arange(to[-1])].tobytes()
    cuts = (2 * np.append(0, to)[np.append(0, np.cumsum(sizes))]).tolist()
    out = [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    if _ODD.search(line):
        odd = np.array([bool(_ODD.search(w.decode("utf-8", "replace"))) for w in names.to_pylist()])
        for i in set(np.repeat(np.arange(len(texts)), sizes)[odd[codes]].tolist()):
            out[i] = _ids(lines[i], path).tobytes()
    return out


def encoded(docs: DataFrame, ranks: str, *, id_col: str = "doc_id", text_col: str = "text", fold: int = 7, out: int = 2) -> DataFrame:
    """(doc_id, held_out, ids): ids as 16-bit integers, without the end. They spell the line, so it isn't kept beside them."""
    held = F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "utf-8")) % fold == out
    if len(_pieces(ranks)) >= 1 << 16:
        raise OverflowError("ids of this vocabulary don't fit 16 bits")

    def make():
        return lambda keys, texts, holds: [keys, holds, packed(texts, ranks)]

    return map_lists(id_and_text(docs, id_col, text_col, held.alias("held_out")), "doc_id long, held_out boolean, ids binary", make)


def spelled(ids: pa.Array, ranks: str) -> pa.Array:
    """The lines that rows of ids (16-bit integers in binaries) stand for."""
    ends = np.cumsum(pc.binary_length(ids).to_numpy().astype(np.int64)) // 2
    flat = np.frombuffer(b"".join(ids.to_pylist()), "<u2")
    parts = _pieces(ranks).take(pa.array(flat))
    places = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset : parts.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int32)
    offsets = places[np.concatenate([[0], ends])].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), parts.buffers()[2] if len(flat) else pa.py_buffer(b"")])


def word_counts(table: DataFrame, ranks: str) -> DataFrame:
    """(word, c) over the training rows; the end counts as a word."""
    schema = T._parse_datatype_string("word binary, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = arrow_type(schema)
        held, rows, lines = [], 0, 0

        def summed() -> pa.Table:
            return pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"]).cast(made)

        for batch in text_batches(batches, 0, STEP_BYTES):
            names, codes, _ = _words(spelled(batch.column(0), ranks))
            times = pa.array(np.bincount(codes, minlength=len(names)).astype(np.int64))
            held.append(pa.record_batch([names.cast(pa.binary()), times], schema=made))
            rows, lines = rows + len(names), lines + batch.num_rows
            if rows > 600_000:
                table = summed()
                held, rows = table.to_batches(), table.num_rows
                if rows > 300_000:
                    yield from table.to_batches(20_000)
                    held, rows = [], 0
                del table
        held.append(pa.record_batch([pa.array([END], pa.binary()), pa.array([lines], pa.int64())], schema=made))
        yield from summed().to_batches(20_000)
        held.clear()
        rested()

    return table.filter("NOT held_out").select("ids").mapInArrow(count, schema).filter("n > 0 AND length(word) > 0").groupBy("word").agg(F.sum("n").alias("c"))


def _sums(table: DataFrame, cells: int, count) -> np.ndarray:
    """A vector of counts over all training rows; ``count`` maps a list of id arrays to the numbers of the cells they count in.

    A task sends each block of cells as one row: packed numbers and counts of those that aren't zero. Blocks are added up
    apart from each other, and come to the driver as one vector.
    """
    schema = T._parse_datatype_string("block int, at binary, n binary")

    def packed(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for block in range(0, cells, BLOCK):
            at = np.flatnonzero(total[block : block + BLOCK])
            if len(at):
                yield pa.record_batch([[block // BLOCK], [at.astype("<u2").tobytes()], [total[block + at].astype("<i8").tobytes()]], schema=arrow_type(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, keys, held = np.zeros(cells, np.int64), [], 0
        for batch in text_batches(batches, 0, STEP_BYTES):
            keys.append(count([np.frombuffer(x, "<u2") for x in batch.column(0).to_pylist()]))
            held += len(keys[-1])
            if held >= cells:
                total += np.bincount(np.concatenate(keys), minlength=cells)
                keys, held = [], 0
        if held:
            total += np.bincount(np.concatenate(keys), minlength=cells)
        yield from packed(total)
        del total, keys
        rested()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums.setdefault(block, np.zeros(BLOCK, np.int64))[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<i8")
        for block, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([[block], [at.astype("<u2").tobytes()], [total[at].astype("<i8").tobytes()]], schema=arrow_type(schema))

    blocks = -(-cells // BLOCK)
    rows = table.filter("NOT held_out").select("ids").mapInArrow(run, schema).repartition(blocks, "block").mapInArrow(add, schema).collect()  # at most a row a block
    out = np.zeros(blocks * BLOCK, np.int64)
    for r in rows:
        out[r["block"] * BLOCK + np.frombuffer(r["at"], "<u2").astype(np.int64)] = np.frombuffer(r["n"], "<i8")
    return out[:cells]


class Model:
    """The trained parts; small enough to travel with each task."""

    def __init__(self, size: int, counts: np.ndarray, classes: np.ndarray):
        self.end, self.classes = size, classes
        total = np.bincount(classes, counts + 0.1, CLASSES)
        self.inside = np.log((counts + 0.1) / total[classes])
        self.first, self.second, self.p = None, None, lm.fresh(CLASSES)
        self.windows: list[int] = []  # that gave gradients, by round

    def around(self, ids: np.ndarray) -> np.ndarray:
        """Classes of end, ids, end: inputs are all but the last, targets all but the first."""
        return self.classes[np.concatenate([[self.end], ids, [self.end]])]

    def scores(self, all_ids: list[np.ndarray]) -> list[float]:
        """Natural logarithms of the probabilities of whole texts."""
        rows = [self.around(x) for x in all_ids]
        each = lm.class_scores(self.p, self.first, self.second, [r[:-1] for r in rows], [r[1:] for r in rows]).astype(np.float64)
        ends = np.cumsum([len(x) + 1 for x in all_ids])
        each += self.inside[np.concatenate([y for x in all_ids for y in (x, [self.end])])]
        return np.add.reduceat(each, np.concatenate([[0], ends[:-1]])).tolist()


def _round(table: DataFrame, model: Model, turn: int) -> None:
    """One round of local training over every window; sets the model's weights to the mean over tasks."""
    names = list(model.p)
    schema = T._parse_datatype_string("part int, windows double, weights binary")
    start, pad = model.p, CLASSES

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        p, squares, done, at = start, None, 0, np.arange(lm.WINDOW)
        contexts, targets, held = [], [], 0

        def learned():
            c, t = np.concatenate(contexts), np.concatenate(targets)
            mixed = np.random.default_rng(turn).permutation(len(c))
            return lm.train(p, model.first, model.second, c[mixed], t[mixed], squares, rate=0.1 / (1 + turn))

        for batch in text_batches(batches, 0, STEP_BYTES):
            rows = [model.around(np.frombuffer(x, "<u2")) for x in batch.column(0).to_pylist()]
            buf, starts = lm.segments([r[:-1] for r in rows], pad)
            goal, _ = lm.segments([r[1:] for r in rows], pad)
            for i in range(0, len(starts), lm.HELD):
                place = starts[i : i + lm.HELD, None] + at
                contexts.append(buf[place])
                targets.append(goal[place[:, -lm.STEP :]])
                held += len(place)
                if held >= lm.HELD:
                    p, squares = learned()
                    done, held = done + held, 0
                    contexts.clear()
                    targets.clear()
        if held:
            p, squares = learned()
            done += held
        if done:
            flat = np.concatenate([p[n].ravel() for n in names]).astype("<f4")
            yield pa.record_batch([[TaskContext.get().partitionId() % 16], [float(done)], [(flat * done).tobytes()]], schema=arrow_type(schema))
        rested()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0.0, None
        for batch in batches:
            for w, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n, total = n + w, np.frombuffer(raw, "<f4").astype(np.float64) + (0 if total is None else total)
        if n:
            yield pa.record_batch([[0], [n], [total.astype("<f4").tobytes()]], schema=arrow_type(schema))

    rows = table.filter("NOT held_out").select("ids").mapInArrow(learn, schema).repartition(16, "part").mapInArrow(add, schema).collect()  # at most 16 rows
    model.windows.append(round(sum(r["windows"] for r in rows)))
    if rows:
        flat, at = sum(np.frombuffer(r["weights"], "<f4").astype(np.float64) for r in rows) / sum(r["windows"] for r in rows), 0
        for n in names:
            model.p[n] = flat[at : at + model.p[n].size].reshape(model.p[n].shape).astype(np.float32)
            at += model.p[n].size


def fit(table: DataFrame, size: int, rounds: int = 2) -> Model:
    """Learn from the rows that aren't held out; ``size``: how many ids the encoder has; the end is one more."""
    end = lambda rows: np.concatenate([y for x in rows for y in (x, [size])])
    counts = _sums(table, size + 1, end)
    order = np.lexsort((np.arange(size + 1), -counts))
    kind = np.full(size + 1, KINDS - 1, np.int64)
    kind[order[: KINDS - 1]] = np.arange(KINDS - 1)

    def preceded(rows):
        line = np.concatenate([[size], end(rows)])
        return line[1:] * KINDS + kind[line[:-1]]

    before = _sums(table, (size + 1) * KINDS, preceded).reshape(-1, KINDS)
    model = Model(size, counts, lm.token_classes(counts, before, CLASSES, SHARED))
    classes = model.classes.astype(np.int64)

    def pairs(rows):
        line = classes[np.concatenate([[size], end(rows)])]
        return line[:-1] * CLASSES + line[1:]

    both = _sums(table, CLASSES * CLASSES, pairs).reshape(CLASSES, CLASSES).astype(np.float64)
    model.first, model.second = lm.bigrams(both)
    for turn in range(rounds):
        _round(table, model, turn)
    return model


def scores(docs: DataFrame, ranks: str, *, rounds: int = 2, hot_words: int = 250_000, **columns) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and score (base-10 logarithms)."""
    spark = docs.sparkSession
    table = stored(encoded(docs, ranks, **columns), "lm-encoded")
    counts = stored(word_counts(table, ranks), "lm-words")
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    total, distinct = int(total or 0), int(distinct or 0)
    divisor = max(1, total + distinct + 1)
    # the lowest count that at most ``hot_words`` words reach
    by_count = counts.groupBy("c").count().filter("c > 1").orderBy(F.desc("c")).limit(hot_words).collect()
    reached, least = 0, None
    for row in by_count:
        reached += row["count"]
        if reached > hot_words:
            break
        least = row["c"]
    common = {bytes(r["word"]): r["c"] for r in counts.filter(F.col("c") >= least).collect()} if least is not None else {}
    ended = math.log10((common[END] + 1) / divisor) if END in common else None
    costs = np.array([math.log10((c + 1) / divisor) for c in common.values()])
    hot = spark.sparkContext.broadcast((b"".join(common), [len(w) for w in common], costs, fit(table, len(_ranks(ranks)), rounds)))
    del common
    schema = T._parse_datatype_string("row long, doc_id long, held_out boolean, n_tokens long, score double, word binary, n long, base double, known long")
    made = arrow_type(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        joined, long, costs, model = hot.value
        places = np.cumsum([0, *long]).astype(np.int32)
        frequent = pa.Array.from_buffers(pa.binary(), len(long), [None, pa.py_buffer(places), pa.py_buffer(joined)])
        row = TaskContext.get().partitionId() << 40
        for batch in text_batches(batches, 2, STEP_BYTES):
            n = batch.num_rows
            logs = model.scores([np.frombuffer(x, "<u2") for x in batch.column(2).to_pylist()])
            names, codes, sizes = _words(spelled(batch.column(2), ranks))
            # a step's words make a smaller table to look up in than the frequent ones
            at, cost = pc.index_in(frequent, value_set=names), np.full(len(names), np.nan)
            cost[at.drop_null().to_numpy()] = costs[at.is_valid().to_numpy(zero_copy_only=False)]
            cost = cost[codes]
            owner = np.repeat(np.arange(n), sizes)
            met = ~np.isnan(cost)
            base = np.bincount(owner[met], cost[met], n) + (0.0 if ended is None else ended)
            known = np.bincount(owner[met], minlength=n) + (ended is not None)
            # the row's own word holds a space, so it joins no count
            own = pa.array([b"  %d" % (row + i) for i in range(n)], pa.binary())
            whole = [pa.array(np.arange(row, row + n)), batch.column(0), batch.column(1), pa.array(sizes + 1), pa.array(np.array(logs) / math.log(10)), own, pa.array(np.zeros(n, np.int64)), pa.array(base), pa.array(known)]
            yield pa.record_batch([c.cast(t) for c, t in zip(whole, made.types, strict=True)], schema=made)
            pairs, times = np.unique(owner[~met] * max(1, len(names)) + codes[~met], return_counts=True)
            at, word = np.divmod(pairs, max(1, len(names)))
            rare = [row + at, names.take(pa.array(word)), times]
            if ended is None:
                rare = [np.concatenate([rare[0], row + np.arange(n)]), pa.concat_arrays([rare[1].cast(pa.binary()), pa.array([END] * n, pa.binary())]), np.concatenate([times, np.ones(n, np.int64)])]
            for i in range(0, len(rare[0]), 50_000):
                some = [x[i : i + 50_000] for x in rare]
                columns = [pa.nulls(len(some[0]), t) for t in made.types]
                columns[0], columns[5], columns[6] = pa.array(some[0], pa.int64()), some[1].cast(pa.binary()), pa.array(some[2], pa.int64())
                columns[7], columns[8] = pa.array(np.zeros(len(some[0]))), pa.array(np.zeros(len(some[0]), np.int64))
                yield pa.record_batch(columns, schema=made)
            row += n
        rested()

    seen = table.select("doc_id", "held_out", "ids").mapInArrow(score, schema)
    joined = seen.join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    base = F.col("base") + F.col("n") * F.log10((c + 1) / F.lit(float(divisor)))
    done = joined.groupBy("row").agg(*(F.max(x).alias(x) for x in ("doc_id", "held_out", "n_tokens", "score")), F.sum(base).alias("base_score"), F.sum(F.col("known") + F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"))
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _ranks(path: str) -> range:
    with open(path, "rb") as file:
        return range(sum(1 for line in file if line.strip()))
