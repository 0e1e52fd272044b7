"""Whole-document log-likelihood by a gated recurrent language model (``gru``) and by a unigram base.

Words are counted over all training documents. The most frequent ones have a place in an output class and an input
vector of their own; every rarer word belongs to a class by its last letters and has, within it, its smoothed share of
the class's count. A short warm start on a bounded sample makes one model; then every part of the training documents is learnt
whole, starting there, and the parts' models are averaged by the tokens they saw. Scoring carries the state from a text's
first word to its end.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm import gru
from tarnwork.llm.common import settle, ship, text_or_empty

HEAD, PLACES = 512, 32  # frequent words in classes of so many
TAILS = 32  # classes of rarer words
KNOWN = 200_000  # counts that tasks look up at once; those of rarer words are joined
WARM = 512  # documents of the warm start
ALPHA = 0.1
PART = 2_000_000  # training tokens of one part, which one task learns
# Distinct words counted before a task hands them on; documents, or tokens, learnt side by side; tokens scored so.
FLUSH, SIDE, SIDE_TOKENS, SCORED = 400_000, 4096, 500_000, 2_000_000


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A to Z) runs between white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def tail_class(word: bytes, tails: int = TAILS) -> int:
    return zlib.crc32(word[-3:]) % tails


def count_words(train: DataFrame, tails: int = TAILS) -> DataFrame:
    """``word, cls, c`` over all rows of the text column ``_t``: counted in the tasks, then added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.binary()), "cls": pa.array([tail_class(w, tails) for w in held], pa.int32()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(words_of(text))
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return train.select("_t").mapInArrow(run, "word binary, cls int, n bigint").groupBy("word", "cls").agg(F.sum("n").alias("c"))


def frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The most frequent words, in order: all from some count on, as many as fit ``most``. The count is found from the
    number of words per eighth of an octave, so no task sends more than it has of them."""
    step = F.floor(F.log2("c") * 8).alias("s")
    sizes = counts.groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect()
    least, held = None, 0
    for r in sorted(sizes, key=lambda r: -r["s"]):
        held += r["n"]
        if held > most:
            break
        least = r["c"]
    if least is None:
        return {}
    rows = counts.filter(F.col("c") >= least).select("word", "c").collect()
    return dict(sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0])))


class Words:
    """What tasks need to turn words into tokens of the model."""

    def __init__(self, head: list[bytes], known: dict[bytes, int], mass: list[float], ends: int, total: int, distinct: int):
        self.places, self.head = PLACES, {w: i for i, w in enumerate(head)}
        self.groups = max(1, -(-HEAD // PLACES))
        self.ends = ends
        self.end_class = self.groups
        self.end_input = HEAD
        self.classes = self.groups + 1 + TAILS
        self.inputs = HEAD + 1 + TAILS  # words of the head, the end, classes of the tail
        self.log_all = math.log10(total + ALPHA * (distinct + 1))
        self.log_mass = np.log10(np.maximum(np.array(mass) + ALPHA, 1e-300))
        head_input = np.arange(HEAD)
        tail = np.arange(TAILS + 1)  # the end first
        self.outs = (np.concatenate([head_input // PLACES, self.end_class + tail]).astype(np.int64), np.concatenate([head_input % PLACES, np.full(TAILS + 1, -1)]).astype(np.int64))
        # Of each known word, and last of any other: input, base and constant without what a joined count adds.
        self.number = {w: i for i, w in enumerate(known)}
        part = np.append(np.log10(np.array([*known.values()], float) + ALPHA), 0.0)
        heads = np.array([self.head.get(w, -1) for w in known] + [-1])
        tails = np.array([tail_class(w) for w in known] + [0])
        self.input = np.where(heads >= 0, heads, HEAD + 1 + tails).astype(np.uint16)
        self.base = part - self.log_all
        self.constant = np.where(heads >= 0, 0.0, part - self.log_mass[tails])

    def facts(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, list[bytes], np.ndarray]]:
        """Of each text and its end the input numbers, base, constant and known words; and of all texts the words whose
        counts are joined, as (text, word, how often)."""
        listed = [words_of(t) for t in texts]
        flat = [w for words in listed for w in words]
        other = len(self.number)
        at = np.fromiter(map(self.number.get, flat, repeat(other)), np.int64, len(flat))
        cuts = np.concatenate([[0], np.cumsum([len(words) for words in listed])])
        inputs, constants = self.input[at], self.constant[at]
        rare = np.flatnonzero(at == other)
        names: dict[bytes, int] = {}
        named = np.array([names.setdefault(flat[i], len(names)) for i in rare.tolist()], np.int64)
        word = list(names)
        tails = np.array([tail_class(w) for w in word], np.int64)[named]
        inputs[rare], constants[rare] = HEAD + 1 + tails, -self.log_mass[tails]
        who = np.searchsorted(cuts, rare, side="right") - 1
        pairs, often = np.unique(who << 32 | named, return_counts=True)
        joined = pairs >> 32, [word[k] for k in (pairs & 0xFFFFFFFF).tolist()], often
        known = np.diff(cuts) - np.bincount(who, minlength=len(texts))
        end = math.log10(self.ends + ALPHA) - self.log_all
        every = [np.append(inputs[lo:hi], np.uint16(self.end_input)) for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        # One text after the other, as sums over all texts would lose digits of a short text behind long ones.
        base, constant = (np.array([values[lo:hi].sum() for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]) for values in (self.base[at], constants))
        return every, base + end, constant, known + (self.ends > 0), joined


def train_model(rows: DataFrame, sent, shape: gru.Params, tokens: int) -> gru.Params:
    """Warm start on ``WARM`` different documents (the smallest hashes of their keys), then one pass over all of them.

    Documents are dealt to parts of about ``PART`` tokens by the hash of their key and learnt in the order of their keys, so
    the model depends on the documents and not on how files or tasks hold them; more documents make more parts.
    """
    spark = rows.sparkSession
    count = tokens // PART + 1
    schema = "part int, flat binary, seen bigint"

    def learn(batches: Iterator[pa.RecordBatch], p: gru.Params, lanes: int, rounds: int, rate: float) -> Iterator[pa.RecordBatch]:
        words, now, trainer, held, have = sent.value, None, None, [], 0

        def taught() -> None:
            for _ in range(rounds if held else 0):
                trainer.learn(held, words.end_input, words.outs, lanes)

        def ended() -> Iterator[pa.RecordBatch]:
            if trainer is not None and trainer.seen:
                flat = gru.pack_params(trainer.p).astype(np.float64) * trainer.seen
                yield pa.RecordBatch.from_pydict({"part": pa.array([now], pa.int32()), "flat": pa.array([flat.tobytes()], pa.binary()), "seen": pa.array([trainer.seen], pa.int64())})

        for batch in batches:
            for part, inputs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now or len(held) == SIDE or have > SIDE_TOKENS:
                    taught()
                    held, have = [], 0
                if part != now:
                    yield from ended()
                    now, trainer = part, gru.Trainer(p, rate)
                held.append(np.frombuffer(inputs, "<u2"))
                have += len(held[-1])
        taught()
        yield from ended()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, seen, first = None, 0, None
        for batch in batches:
            for part, f, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                f = np.frombuffer(f, np.float64)
                flat, seen, first = f if flat is None else flat + f, seen + s, part if first is None else first
        if seen:
            yield pa.RecordBatch.from_pydict({"part": pa.array([first], pa.int32()), "flat": pa.array([flat.tobytes()], pa.binary()), "seen": pa.array([seen], pa.int64())})

    def averaged(models: DataFrame) -> gru.Params | None:
        few = math.isqrt(count) + 1  # the sums of so many groups of parts come to the driver
        summed = models.repartitionById(few, F.col("part") % few).sortWithinPartitions("part").mapInArrow(add, schema)
        got = sorted(summed.collect(), key=lambda r: r["part"])
        seen = sum(r["seen"] for r in got)
        return gru.unpack_params(sum(np.frombuffer(r["flat"], np.float64) for r in got) / seen, shape) if seen else None

    train = rows.filter("NOT held_out").select("key", "inputs")
    picked = train.select("key").distinct().orderBy(F.xxhash64("key")).limit(WARM)
    sample = train.join(F.broadcast(picked), "key", "left_semi").dropDuplicates(["key"])
    sample = sample.select(F.lit(0).alias("part"), "inputs", "key").repartition(1).sortWithinPartitions("key").select("part", "inputs")
    warm = averaged(sample.mapInArrow(lambda b: learn(b, shape, 32, 2, 2 * gru.RATE), schema)) or shape
    dealt = train.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(count)).cast("int")).repartitionById(count, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", "key").select("part", "inputs")
    return averaged(settle(ordered.mapInArrow(lambda b: learn(b, warm, gru.LANES, 1, gru.RATE / 2), schema), "models")) or warm


def score_batches(batches: Iterator[pa.RecordBatch], words: Words, p: gru.Params) -> Iterator[pa.RecordBatch]:
    """The columns before the last two, ``n_tokens`` and ``score``, from (..., constant, inputs).

    A step of a few long texts costs nearly as much as one of thousands, so texts are gathered over batches.
    """
    held, every, have = [], [], 0

    def scored() -> Iterator[pa.RecordBatch]:
        out, lo = gru.score(p, gru.Texts(every, words.end_input, words.outs)) / math.log(10), 0
        for batch in held:
            cut = slice(lo, lo := lo + batch.num_rows)
            score = out[cut] + batch.column(batch.num_columns - 1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([len(x) for x in every[cut]], pa.int64()), pa.array(score)], names=[*batch.schema.names[:-1], "n_tokens", "score"])

    for batch in batches:
        for lo in range(0, batch.num_rows, SIDE):
            part = batch.slice(lo, SIDE)
            inputs = part.column(part.num_columns - 1).to_pylist()
            if every and (len(every) + len(inputs) > SIDE or have > SCORED):
                yield from scored()
                held, every, have = [], [], 0
            held.append(pa.RecordBatch.from_arrays(part.columns[:-1], names=part.schema.names[:-1]))
            every += [np.frombuffer(x, "<u2") for x in inputs]
            have += sum(map(len, inputs)) // 2
    if every:
        yield from scored()


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held_fold: int = 0) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Held out are rows with ``crc32(id as text) % folds = held_fold`` and rows with a null id; the others teach. Null
    text is empty: one token, the end. Repeated rows teach and are scored as often as they come. Without any training
    row all counts are zero and the model is the untrained one. Words are looked up once; training and scoring read the
    numbers that the model knows them by.
    """
    spark = df.sparkSession
    ship(spark)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held_fold, F.lit(True))
    rows = df.select(F.col(id_col).alias("_id"), held.alias("held_out"), text_or_empty(text_col).alias("_t"))
    train = rows.filter(~F.col("held_out"))
    counts = settle(count_words(train), "counts")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = train.count()
    total, distinct = sums[0] + ends, sums[1] + (ends > 0)
    known = frequent(counts, KNOWN)
    head = list(known)[:HEAD]
    mass = [0.0] * TAILS
    for r in counts.groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        mass[r["cls"]] = r["c"] + ALPHA * r["n"]
    for w in head:
        mass[tail_class(w)] -= known[w] + ALPHA
    words = Words(head, known, mass, ends, total, distinct)
    sent = spark.sparkContext.broadcast(words)
    shape = gru.start(words.inputs, words.classes, words.groups, words.places)
    # Words of a head shorter than HEAD leave places that no word has.
    for i in range(len(head), HEAD):
        shape["bo"][i // PLACES, i % PLACES] = -30
    kind = df.schema[id_col].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, and one for each of its words whose count is joined."""
        words = sent.value
        names = ["row", "_id", "held_out", "key", "inputs", "n_known", "base", "constant", "word", "n"]
        for batch in batches:
            texts = batch.column(4).to_pylist()
            for lo in range(0, len(texts), SIDE):
                every, base, constant, known_words, (who, word, often) = words.facts(texts[lo:lo + SIDE])
                n, m, part = len(every), len(word), batch.slice(lo, SIDE)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:4], pa.array([x.astype("<u2").tobytes() for x in every], pa.binary()), pa.array(known_words), pa.array(base), pa.array(constant),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
                ], names=names)
                if m:
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(who)), pa.nulls(m, part.column(1).type), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
                        pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), pa.array(word, pa.binary()), pa.array(often),
                    ], names=names)

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "_id", "held_out", F.xxhash64("_id", "_t").alias("key"), "_t")
    seen = settle(numbered.mapInArrow(
        look, f"row bigint, _id {kind}, held_out boolean, key bigint, inputs binary, n_known bigint, base double, constant double, word binary, n bigint"), "seen")
    texts = seen.filter(F.col("word").isNull())
    model = spark.sparkContext.broadcast(train_model(texts, sent, shape, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return score_batches(batches, sent.value, model.value)

    both = texts.select("row", "_id", "held_out", "n_known", "base", "constant", "inputs").mapInArrow(
        run, f"row bigint, _id {kind}, held_out boolean, n_known bigint, base double, n_tokens bigint, score double")
    rare = seen.filter(F.col("word").isNotNull()).select("row", "word", "n").join(counts.select("word", "c"), "word", "left")
    late = rare.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + ALPHA)).alias("_l"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("_k"))
    done = both.join(late, "row", "left")
    extra = F.coalesce("_l", F.lit(0.0))
    return done.select(
        F.col("_id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_k", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"), (F.col("score") + extra).alias("score"),
    )
