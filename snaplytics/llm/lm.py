"""Scoring texts with a hashed maximum-entropy language model.

Text is lower-cased (A-Z) and cut into words; an end token closes every text. A token's
probability is factored: P(class | history) * P(member | class, history) * P(word | bucket).
The ``OWN_BUCKETS`` most frequent training tokens have a bucket each, all others share the
rest by a hash of their last characters; a bucket is a member of a class. Class and
member are softmax models over hashed history features: the word before (bigram), the two
words before (trigram) and the word before the last (skip); in the second softmax a
feature is hashed together with the class. Inside a bucket a word has its smoothed relative
frequency, with one place for unknown words.

Training is distributed: each round every task runs over the numpy batches of its chunks,
sums observed and expected feature counts (their difference is the gradient of the
log-likelihood; the observed ones once, as they stay the same) and Spark adds the tasks' sums up by model row; the driver takes a step
scaled by the counts and sends the model (fixed size, a parameter) out again. All training
texts take part in every round, so what is summed grows with the corpus. In the first
round the weights are zero and the expected counts follow from counts by class.

Text is tokenized once: chunks of whole documents (about ``CHUNK_TOKENS`` tokens) are stored
with integer tokens and a dictionary of their distinct words. Corpus counts are
aggregated from the dictionaries. Those of the ``FREQUENT_WORDS`` most frequent words (a fixed
number) are sent to all tasks; all others go back to the chunks by a join on the word.

Cases: a null text is empty (one token, the end); a null ``doc_id`` trains; without
training texts all words are unknown and the model is uniform; repeated rows count and
score each; an empty table gives an empty result; extra columns are not touched. A text
longer than a chunk makes a chunk of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

CLASSES = 32
MEMBERS = 32
BUCKETS = CLASSES * MEMBERS
OWN_BUCKETS = 512       # the most frequent tokens
ROW_BITS = 12
ROWS = 1 << ROW_BITS    # hashed rows of each feature's weights
FEATURES = 3            # bigram, skip, trigram
ROUNDS = 2
PRIOR = 8.0             # pseudo-counts that damp the step of rare rows
MAX_STEP = 1.5
CHUNK_TOKENS = 800_000
FREQUENT_WORDS = 200_000  # whose counts are sent to all tasks (about 6 MB); other words' counts are joined
BATCH = 1 << 13         # tokens at a time, so that a batch's arrays stay in the cache
BLOCK = 3 << 18         # tuples whose probabilities are added up by row at a time (100 MB at most)
SUFFIX = 3
START = 0x5BD1E995      # history before the first word

CHUNK = "chunk bigint, doc_id array<bigint>, held array<boolean>, size array<int>, ids binary, words array<string>, counts array<int>"


def cells(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each row of a list column as a numpy array, one at a time; null stays null."""
    for row in column:
        yield None if row.values is None else row.values.to_numpy(zero_copy_only=False)


def packed(ids: np.ndarray) -> bytes:
    return pa.compress(ids.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def unpacked(ids: bytes, sizes: np.ndarray) -> np.ndarray:
    return np.frombuffer(pa.decompress(ids, 4 * int(sizes.sum()), codec="zstd"), "<i4")


class Numbering(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def chunked(docs: DataFrame) -> DataFrame:
    """(doc_id, text, held_out) -> chunks of whole documents with integer tokens."""

    def pack(part: int, number: int, doc_ids, held, sizes, ids, words) -> pa.RecordBatch:
        flat = np.concatenate(ids)
        train = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(flat[train], minlength=len(words)).astype(np.int32)
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        spelled = pa.array(list(words), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + number], pa.int64()), one(doc_ids, pa.int64()), one(held, pa.bool_()), one(sizes, pa.int32()),
             pa.array([packed(flat)], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), spelled), one(counts, pa.int32())],
            [c.split()[0] for c in CHUNK.split(", ")])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, total = TaskContext.get().partitionId(), 0, 0
        words, doc_ids, held, sizes, ids = Numbering({b"": 0}), [], [], [], []
        for batch in batches:
            for doc_id, text, out in zip(*(batch.column(i) for i in range(3))):
                tokens = (text.as_py() or "").encode().lower().split()  # bytes: ASCII case and white space
                numbers = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
                doc_ids.append(doc_id.as_py())
                held.append(out.as_py())
                sizes.append(len(tokens) + 1)
                ids.append(np.append(numbers, np.int32(0)))
                total += len(tokens) + 1
                if total >= CHUNK_TOKENS:
                    yield pack(part, number, doc_ids, held, sizes, ids, words)
                    number, total = number + 1, 0
                    words, doc_ids, held, sizes, ids = Numbering({b"": 0}), [], [], [], []
        if doc_ids:
            yield pack(part, number, doc_ids, held, sizes, ids, words)

    return docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(chunks, CHUNK)


# ---- the model -----------------------------------------------------------------------------


class Model:
    """Weights of both softmax layers; rows of the tables are hashed features."""

    def __init__(self, own: dict[str, int], bucket_tokens: np.ndarray, bucket_words: np.ndarray):
        self.own, self.tokens, self.words = own, bucket_tokens, bucket_words
        counts = (bucket_tokens + 1.0).reshape(CLASSES, MEMBERS)
        self.class_bias = np.log(counts.sum(axis=1) / counts.sum()).astype(np.float32)
        self.member_bias = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
        # layer, feature, row, output; only ``step`` changes them once a layer has been worked out
        self.weights = np.zeros((2, FEATURES, ROWS, MEMBERS), np.float32)
        self.powers: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def buckets(self, words: list[str]) -> np.ndarray:
        out = np.fromiter(map(SHARED.__getitem__, [w[-SUFFIX:] for w in words]), np.int64, len(words))
        own = self.own
        for at in [i for i, w in enumerate(words) if w in own]:
            out[at] = own[words[at]]
        return out

    def layer(self, which: int, rows: list[np.ndarray], cls: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Exponentials (token by output) and their sums; a step is clipped, so none overflows. Those of the
        weights are taken once for all tokens: a token's are their products."""
        if self.powers is None:
            self.powers = np.exp(self.weights), np.exp(self.class_bias), np.exp(self.member_bias)
        weights, class_prior, member_prior = self.powers
        z = np.take(weights[which, 0], rows[0], axis=0, out=out, mode="clip")
        for k in range(1, FEATURES):
            z *= weights[which, k].take(rows[k], axis=0)
        z *= member_prior.take(cls, axis=0) if which else class_prior
        return z, z @ np.ones(MEMBERS, np.float32)

    def step(self, table_rows: np.ndarray, observed: np.ndarray, expected: np.ndarray) -> None:
        """One scaled gradient step on the rows (layer * FEATURES + feature) * ROWS + row."""
        step = (observed - expected) / (0.5 * (observed + expected) + PRIOR)
        step = np.clip(step, -MAX_STEP, MAX_STEP) / FEATURES * 1.5
        self.weights.reshape(-1, MEMBERS)[table_rows] += step.astype(np.float32)
        self.powers = None


def shared_bucket(word: str) -> int:
    return OWN_BUCKETS + zlib.crc32(word[-SUFFIX:].encode()) % (BUCKETS - OWN_BUCKETS)


class SharedBuckets(dict):
    """The shared buckets of endings met so far; forgets them beyond a fixed number."""

    def __missing__(self, ending: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[ending] = bucket = shared_bucket(ending)
        return bucket


SHARED = SharedBuckets()


def bucket_column(word: Column, own: Column) -> Column:
    """The same in the JVM; own: the word's own bucket or null."""
    tail = F.when(F.length(word) > SUFFIX, F.substring(word, -SUFFIX, SUFFIX)).otherwise(word)
    return F.coalesce(own, F.lit(OWN_BUCKETS) + F.crc32(F.encode(tail, "utf-8")) % (BUCKETS - OWN_BUCKETS)).cast("int")


def mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A hash of two unsigned 32-bit values."""
    x = (a * np.uint32(0x9E3779B1)) ^ (np.uint32(b) if np.isscalar(b) else b)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA77)
    return x ^ (x >> np.uint32(13))


def histories(ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """Each token's features as unsigned 32-bit hashes: bigram, skip, trigram."""
    token = hashes[ids]
    start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    one, two = np.empty_like(token), np.empty_like(token)
    one[1:], two[2:] = token[:-1], token[:-2]
    one[start] = START
    two[:1] = START
    two[start] = START
    second = start + 1
    two[second[sizes > 1]] = START
    return [mixed(one, 1), mixed(two, 2), mixed(one, mixed(two, 3))]


def chunk_rows(model: Model, ids, sizes, words, wanted=None):
    """Of a chunk's tokens (those wanted): class, member, and for each layer the rows of its features."""
    hashes = np.fromiter(map(zlib.crc32, map(str.encode, words)), np.uint32, len(words))
    bucket = model.buckets(words)[ids]
    features = histories(ids, sizes, hashes)
    if wanted is not None:
        bucket, features = bucket[wanted], [f[wanted] for f in features]
    cls, member = bucket // MEMBERS, bucket % MEMBERS
    salt = (cls + 7).astype(np.uint32)
    rows = [[(f & np.uint32(ROWS - 1)).astype(np.uint16) for f in features],
            [(mixed(f, salt) & np.uint32(ROWS - 1)).astype(np.uint16) for f in features]]
    return cls, member, rows


def distinct_tuples(rows: list[np.ndarray], cls: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The distinct (rows, class) tuples, ordered by the first feature's row, and how often each occurs."""
    key = rows[0].astype(np.int64)
    for r in rows[1:]:
        key = key << ROW_BITS | r
    key = key * CLASSES + cls
    key.sort()
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    counts = np.diff(np.append(starts, len(key))).astype(np.float32)
    key = key[starts]
    places = key // CLASSES
    rows = [(places >> ROW_BITS * (FEATURES - 1 - k) & (ROWS - 1)).astype(np.uint16) for k in range(FEATURES)]
    return rows, key % CLASSES, counts


def add_expected(model: Model, layer: int, rows: list[np.ndarray], cls: np.ndarray, expected: np.ndarray) -> None:
    """Add the probabilities of all outputs to the rows of each token's features. Equal tuples have equal
    probabilities, so each is computed once and counted as often as it occurs."""
    rows, cls, counts = distinct_tuples(rows, cls if layer else np.zeros_like(cls))
    size = min(BLOCK, len(cls))
    e, weight = np.empty((size, MEMBERS), np.float32), np.empty(size, np.float32)
    for low in range(0, len(cls), BLOCK):
        high = min(low + BLOCK, len(cls))
        for lo in range(low, high, BATCH):
            at = slice(lo, min(lo + BATCH, high))
            here = slice(at.start - low, at.stop - low)
            _, total = model.layer(layer, [r[at] for r in rows], cls[at], e[here])
            np.divide(counts[at], total, out=weight[here])
        for k, r in enumerate(rows):
            r, w, order = r[low:high], weight[:high - low], None
            if k:  # the first feature is in order
                order = np.argsort(r, kind="stable")
                r, w = r[order], w[order]
            new = np.concatenate(([True], r[1:] != r[:-1]))
            new[::BATCH] = True  # sums of a frequent row stay short in single precision
            starts = np.flatnonzero(new)
            sums = expected[layer, k]
            for row, lo, hi in zip(r[starts].tolist(), starts.tolist(), np.append(starts[1:], len(r)).tolist()):
                sums[row] += w[lo:hi] @ (e[lo:hi] if order is None else e.take(order[lo:hi], axis=0))


OBSERVED, EXPECTED = [f"o{j}" for j in range(MEMBERS)], [f"e{j}" for j in range(MEMBERS)]


def gradient_sums(chunks: DataFrame, shared, first: bool) -> DataFrame:
    """Expected counts of every model row that the training texts touch; in the first round, whose
    weights are zero, also the observed ones, which stay the same."""
    columns = EXPECTED + OBSERVED * first

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        observed = np.zeros((2, FEATURES, ROWS * MEMBERS))
        expected = np.zeros((2, FEATURES, ROWS, MEMBERS))
        for batch in rows:
            held, sizes, ids, words = batch.columns
            for held, sizes, ids, words in zip(cells(held), cells(sizes), ids, cells(words)):
                ids = unpacked(ids.as_py(), sizes)
                cls, member, places = chunk_rows(model, ids, sizes, words.tolist(), np.repeat(~held.astype(bool), sizes))
                if first:  # probabilities depend on the class alone: counts by class suffice
                    for layer, prior in ((0, np.tile(np.exp(model.class_bias), (CLASSES, 1))), (1, np.exp(model.member_bias))):
                        for k in range(FEATURES):
                            at = places[layer][k].astype(np.int64) * MEMBERS
                            by_class = np.bincount(at + cls, minlength=ROWS * CLASSES)
                            observed[layer, k] += np.bincount(at + member, minlength=ROWS * MEMBERS) if layer else by_class
                            expected[layer, k] += by_class.reshape(ROWS, CLASSES) @ prior
                    continue
                for layer in (0, 1):
                    if len(cls):
                        add_expected(model, layer, places[layer], cls, expected)
        values = [x.reshape(-1, MEMBERS) for x in ([expected, observed] if first else [expected])]
        touched = np.flatnonzero(values[0].sum(axis=1))
        if len(touched):
            values = np.concatenate([x[touched] for x in values], axis=1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(touched.astype(np.int32)), *[pa.array(np.ascontiguousarray(v)) for v in values.T]],
                                             ["model_row", *columns])

    schema = "model_row int, " + ", ".join(f"{c} float" for c in columns)
    parts = chunks.select("held", "size", "ids", "words").mapInArrow(sums, schema)
    return parts.groupBy("model_row").agg(*[F.sum(c).alias(c) for c in columns])


def token_counts(chunks: DataFrame) -> DataFrame:
    """(word, c) over the training texts; the end token is the empty word."""
    each = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts")
    return each.filter("counts > 0").groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("c"))


def train(spark: SparkSession, chunks: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    top = [r.word for r in counts.orderBy(F.desc("c"), "word").limit(OWN_BUCKETS).collect()]
    own = {w: i for i, w in enumerate(top)}
    named = spark.createDataFrame(list(own.items()), "own_word string, own int")  # OWN_BUCKETS rows at most
    placed = counts.join(F.broadcast(named), F.col("word") == F.col("own_word"), "left")
    bucket = placed.groupBy(bucket_column(F.col("word"), F.col("own")).alias("bucket")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    tokens, words = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in bucket.collect():  # BUCKETS rows at most
        tokens[r.bucket], words[r.bucket] = r.n, r.v
    model = Model(own, tokens, words)
    observed = np.zeros((2 * FEATURES * ROWS, MEMBERS))
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        sums = staged(gradient_sums(chunks, shared, number == 0), "lm-sums").toArrow()  # one row per model row at most
        shared.unpersist()
        if not sums.num_rows:
            break
        touched = sums.column("model_row").to_numpy()
        if number == 0:
            observed[touched] = np.stack([sums.column(c).to_numpy() for c in OBSERVED], axis=1)
        model.step(touched, observed[touched], np.stack([sums.column(c).to_numpy() for c in EXPECTED], axis=1))
    return model


def score_chunks(spark: SparkSession, chunks: DataFrame, counts: DataFrame, model: Model, n: int, v: int) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, base_score, score."""
    frequent = counts.orderBy(F.desc("c"), "word").limit(FREQUENT_WORDS)
    named = frequent.toArrow()  # FREQUENT_WORDS rows at most
    named = dict(zip(named.column("word").to_pylist(), named.column("c").to_pylist()))
    least = min(named.values(), default=0)  # every more frequent word is among them
    rare = counts.filter(F.col("c") <= least)
    each = chunks.select("chunk", F.posexplode("words").alias("at", "word"))
    # most of a chunk's words are frequent ones: left out before the others are shuffled; fewer than FREQUENT_WORDS
    sent = F.broadcast(counts.filter(F.col("c") > least).select("word"))
    known = each.join(sent, "word", "left_anti").join(rare, "word").select("chunk", F.struct("at", "c").alias("w"))
    known = known.groupBy(F.col("chunk").alias("k_chunk")).agg(F.collect_list("w").alias("w"))
    known = known.select("k_chunk", F.col("w.at").alias("at"), F.col("w.c").alias("c"))
    full = chunks.drop("counts").join(known, F.col("chunk") == F.col("k_chunk"), "left")
    shared, shared_counts = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(named)

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        frequent = shared_counts.value
        for batch in rows:
            doc_ids, held, sizes, ids, words, at, rare_c = batch.columns
            for doc_ids, held, sizes, ids, words, at, rare_c in zip(doc_ids, held, cells(sizes), ids, cells(words), cells(at), cells(rare_c)):
                words = words.tolist()
                c = np.fromiter(map(frequent.get, words, repeat(0)), np.float64, len(words))
                if at is not None:
                    c[at] = rare_c
                ids = unpacked(ids.as_py(), sizes)
                start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                bucket = model.buckets(words)
                base = np.log10((c + 1) / (n + v + 1.0))[ids]
                total = np.log10((c + 1) / (model.tokens[bucket] + model.words[bucket] + 1.0))[ids]
                cls, member, places = chunk_rows(model, ids, sizes, words)
                for lo in range(0, len(cls), BATCH):
                    at = slice(lo, lo + BATCH)
                    for layer, y in ((0, cls[at]), (1, member[at])):
                        e, sums = model.layer(layer, [r[at] for r in places[layer]], cls[at])
                        total[at] += np.log10(e[np.arange(len(y)), y] / sums)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, held.values, pa.array(sizes.astype(np.int64)),
                     pa.array(np.add.reduceat((c > 0)[ids].astype(np.int64), start)), pa.array(np.full(len(sizes), n, np.int64)),
                     pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(total, start))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return full.select("doc_id", "held", "size", "ids", "words", "at", "c").mapInArrow(
        score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def lm_scores(docs: DataFrame, held_out: Column, rounds: int = ROUNDS) -> DataFrame:
    """Train on the documents that are not held out, score all of them."""
    spark = docs.sparkSession
    chunks = staged(chunked(docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))), "lm-chunks", "zstd")
    counts = staged(token_counts(chunks), "lm-counts", "zstd")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    return score_chunks(spark, chunks, counts, train(spark, chunks, counts, rounds), n, v)


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm_scores(table(spark, sf_dir, "documents"), held_out)
