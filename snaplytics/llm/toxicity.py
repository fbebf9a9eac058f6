"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Words and word beginnings that separate the labelled training documents become lexicons;
with small fixed lexicons and patterns of writing they make a few dozen voters, each of
which fires on a document or not. The label model is a mixture of two classes in which every
voter depends on the class and on one other voter (a tree of the strongest correlations
within classes); its accuracies and correlations are estimated by expectation
maximisation over the counts of vote patterns of all training documents, labelled or
not, where a label fixes a document's class. A silent voter abstains: only votes cast move the
class (some voters fire by the number of toxic words, none included). The posterior class of every training
document is then the target of a logistic regression on lexicon words and votes, and that
classifier scores every document from its text alone.

Training documents are those whose crc32(doc_id) mod 3 is not 1; no label of any other is
read. Lexicons come from at most ``MINE_ROWS`` labelled documents a class (expected number,
chosen by hash); everything else covers all rows. Texts are read in one pass and not shuffled:
the sample's ids are broadcast (their number is bounded) and what is kept of a text are its
lexicon hits. Expected counts are summed as integers, so the label model does not
depend on how rows are dealt to tasks.

Cases: a null text counts as empty and is scored like one; labels that are null or of unknown
documents are ignored, of several labels for one id the mean decides (a tie is toxic);
a null ``doc_id`` has no label and is not held out; repeated rows are scored each; without any
label the fixed lexicons start the label model; an empty table gives no rows; words beyond
``WORD_CHARS`` characters count by their beginnings only; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged, table

#: Labelled training documents of each class from which lexicons are mined (expected number at most).
MINE_ROWS = 8192
#: Lexicon entries for either class.
TOXIC_WORDS, CLEAN_WORDS = 2048, 256
#: Entries need so many documents of their class and a gain in log-likelihood this far above
#: the logarithm of the number of candidates; voters' entries such a ratio of rates.
MIN_DOCS, MIN_GAIN, MIN_RATIO = 3, 2.0, 8.0
#: Lexicon voters for each kind of entry (whole words, beginnings of each length).
PARTS = 3
PREFIXES = (4, 5, 6, 7)
WORD_CHARS = 32
THRESHOLD = 0.7
EM_ROUNDS = 8

# Plain insults, one lexicon voter a language.
SEEDS = {
    "seed_en": "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown fool jerk",
    "seed_de": "idiot dumm dummkopf trottel abschaum blödmann arschloch depp versager wertlos",
    "seed_fr": "idiot idiote imbécile crétin connard stupide ordure minable abruti débile",
    "seed_es": "idiota imbécil estúpido estúpida basura inútil payaso escoria tonto patético",
}
SECOND_PERSON = "you your yours yourself du dich dir dein tu toi vous votre tú ti usted tus"

WORD = re.compile(r"\w+")
#: Patterns of writing, each a voter: the text matches.
PATTERNS = {
    "exclaims": re.compile(r"!\s*!|!.*!.*!", re.S), "masked": re.compile(r"\w[#*$%&]{2,}"), "stretched": re.compile(r"(\w)\1{3}"),
    "shouts": re.compile(r"\b[A-Z]{4,}\b(?:\W+[A-Z]{4,}\b){2}"), "asks": re.compile(r"\?\s*\?|\?!|!\?"), "linked": re.compile(r"https?://|\w@\w"),
}
#: Voters that fire by how many different words toxic lexicons hold: exactly so many, the last also on more.
AMOUNTS = ("no_toxic_word", "one_toxic_word", "two_toxic_words", "three_toxic_words", "many_toxic_words")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def entries_of(word: str) -> list[str]:
    """The lexicon entries a word can match: itself, and its beginnings."""
    whole = [f"={word}"] if len(word) <= WORD_CHARS else []
    return whole + [f"^{word[:n]}" for n in PREFIXES if len(word) >= n]


def training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 != 1


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic: boolean) of training documents."""
    rows = labels.filter(F.col("toxic").isNotNull() & training(F.col("doc_id")))
    return staged(rows.groupBy("doc_id").agg((F.avg((F.col("toxic") > 0).cast("double")) >= 0.5).alias("toxic")), "toxic-labels")


@dataclass
class Lexicon:
    """Entries with their numbers, and the voters' names and entries."""
    entries: dict[str, int]
    voters: list[str]
    lexicons: dict[str, set[str]]

    def insults(self) -> int:
        """The bits of voters for toxic words."""
        return sum(1 << k for k, name in enumerate(self.voters) if name.startswith(("seed_", "word_", "start")))


def mine(docs: DataFrame, labels: DataFrame, rows: int = MINE_ROWS) -> Lexicon:
    """Entries that tell the classes apart, from a bounded sample of labelled documents."""
    sizes = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 20))
    share = F.when(F.col("toxic"), F.lit(rows / max(1, sizes.get(True, 0)))).otherwise(F.lit(rows / max(1, sizes.get(False, 0))))
    sample = F.broadcast(labels.filter(draw < share * (1 << 20)))  # about 2 * rows rows at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        def out():
            keys = list({**counts[0], **counts[1]})
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()),
                                              pa.array([counts[0][k] for k in keys], pa.int64())], ["entry", "toxic", "clean"])
            for c in counts:
                c.clear()
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                counts[toxic.as_py()].update({e for w in words_of(text.as_py() or "") for e in entries_of(w)})
                if sum(map(len, counts)) > 500_000:
                    yield from out()
        yield from out()

    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    drawn = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic")
    counted = staged(drawn.mapInArrow(count, "entry string, toxic long, clean long")
                     .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-counts")
    n1, n0 = (min(rows, max(1, sizes.get(k, 0))) for k in (True, False))
    rate1, rate0 = (t + 0.5) / (n1 + 1), (c + 0.5) / (n0 + 1)
    def gain(n, k):  # what a table's row adds to the log-likelihood ratio
        return n * F.log((n + 0.5) / ((t + c + 1) * (k / (n1 + n0))))
    scored = counted.select("entry", "toxic", "clean", (rate1 / rate0).alias("ratio"), (gain(t, n1) + gain(c, n0)).alias("gain"))
    best = [F.desc("gain"), F.asc("entry")]
    candidates = counted.filter((t >= MIN_DOCS) | (c >= MIN_DOCS)).count()
    telling = scored.filter(F.col("gain") > math.log(candidates + 1) + MIN_GAIN)
    toxic = telling.filter((F.col("ratio") > 2) & (F.col("toxic") >= MIN_DOCS)).orderBy(*best).limit(TOXIC_WORDS).collect()
    clean = telling.filter((F.col("ratio") < 0.5) & (F.col("clean") >= MIN_DOCS)).orderBy(*best).limit(CLEAN_WORDS).collect()

    kinds: dict[str, list[str]] = {}
    for r in toxic:
        if r["ratio"] >= MIN_RATIO:
            kinds.setdefault("word" if r["entry"][0] == "=" else f"start{len(r['entry']) - 1}", []).append(r["entry"])
    lexicons = {f"{kind}_{p}": set(found[p::PARTS]) for kind, found in sorted(kinds.items()) for p in range(PARTS) if found[p::PARTS]}
    lexicons |= {name: {f"={w}" for w in words.split()} for name, words in SEEDS.items()}
    lexicons["second_person"] = {f"={w}" for w in SECOND_PERSON.split()}
    if clean:
        lexicons["clean_words"] = {r["entry"] for r in clean[:PARTS * 8]}
    entries = {e: i for i, e in enumerate(sorted({r["entry"] for r in (*toxic, *clean)}))}
    return Lexicon(entries, [*lexicons, *PATTERNS, *AMOUNTS], lexicons)


def read_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, train, votes (a bit per voter) and hits (numbers of entries) of every document."""
    bits = {}
    for k, name in enumerate(lexicon.voters):
        for e in lexicon.lexicons.get(name, ()):
            bits[e] = bits.get(e, 0) | 1 << k
    patterns = [(1 << k, PATTERNS[name]) for k, name in enumerate(lexicon.voters) if name in PATTERNS]
    insults = lexicon.insults()
    amounts = [1 << lexicon.voters.index(name) for name in AMOUNTS]
    numbers = lexicon.entries

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, tuple[int, ...]]] = {}
        nothing = (0, ())
        for batch in batches:
            votes, hits = [], []
            for cell in batch.column(1):
                text = cell.as_py() or ""
                vote, found, amount = 0, set(), 0
                for w in words_of(text):
                    what = known.get(w)
                    if what is None:
                        own = entries_of(w)
                        b = 0
                        for e in own:
                            b |= bits.get(e, 0)
                        what = (b, tuple(numbers[e] for e in own if e in numbers))
                        if len(known) > 500_000:
                            known.clear()
                        known[w] = what if b or what[1] else nothing
                    if what is not nothing:
                        vote |= what[0]
                        found.update(what[1])
                        amount += what[0] & insults != 0
                vote |= amounts[min(amount, len(amounts) - 1)]
                for bit, pattern in patterns:
                    if pattern.search(text):
                        vote |= bit
                votes.append(vote)
                hits.append(sorted(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.int64()), pa.array(hits, pa.list_(pa.int32()))],
                                             ["doc_id", "votes", "hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, "doc_id long, votes long, hits array<int>")
    return rows.withColumn("train", F.coalesce(training(F.col("doc_id")), F.lit(True)))


@dataclass
class LabelModel:
    """P(toxic), and for every voter its parent and P(fires | class, parent fires or not)."""
    prior: float
    parent: np.ndarray
    fires: np.ndarray  # voter x class x parent's vote

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Of toxic against clean, for rows of 0 / 1 votes."""
        parents = np.where(self.parent >= 0, votes[:, self.parent], 0)
        p = self.fires[np.arange(votes.shape[1])[None, :], :, parents]  # row x voter x class
        logs = np.where(votes[:, :, None] == 1, np.log(p), 0.0).sum(1)
        return math.log(self.prior / (1 - self.prior)) + logs[:, 1] - logs[:, 0]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -50, 50)))

    def accuracies(self) -> np.ndarray:
        """voter x class: P(fires | class) where the parent is silent."""
        return self.fires[:, :, 0]

    @classmethod
    def fit(cls, pairs: np.ndarray, sizes: np.ndarray, prior: float, tree: bool) -> "LabelModel":
        """From expected counts: ``pairs[class]`` has both voters firing (one voter on the diagonal).
        The prior is given: votes that may be silent don't tell it."""
        m = pairs.shape[1]
        alone = np.diagonal(pairs, axis1=1, axis2=2)
        parent = strongest_tree(pairs, sizes) if tree else np.full(m, -1)
        fires = np.empty((m, 2, 2))
        for j, q in enumerate(parent):
            for y in range(2):
                with_q, both = (alone[y, q], pairs[y, j, q]) if q >= 0 else (0.0, 0.0)
                base = (alone[y, j] + 0.5) / (sizes[y] + 1)
                fires[j, y, 1] = (both + base) / (with_q + 1) if q >= 0 else base
                fires[j, y, 0] = (alone[y, j] - both + base) / (sizes[y] - with_q + 1) if q >= 0 else base
        return cls(prior, parent, np.clip(fires, 1e-6, 1 - 1e-6))


def strongest_tree(pairs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each voter's parent in the maximum spanning tree of mutual information within classes; -1: the root."""
    m = pairs.shape[1]
    info = np.zeros((m, m))
    for y in range(2):
        n = sizes[y] + 4
        one = np.diagonal(pairs[y])
        for a in (0, 1):
            for b in (0, 1):
                row, col = (one if a else sizes[y] - one), (one if b else sizes[y] - one)
                both = pairs[y] if a and b else one[:, None] - pairs[y] if a else one[None, :] - pairs[y] if b else sizes[y] - one[:, None] - one[None, :] + pairs[y]
                p = (np.maximum(both, 0) + 1) / n
                info += sizes[y] * p * np.log(p / ((row[:, None] + 2) / n * (col[None, :] + 2) / n))
    parent, inside = np.full(m, -1), [0]
    while len(inside) < m:
        outside = [j for j in range(m) if j not in inside]
        best = info[np.ix_(inside, outside)]
        i, j = np.unravel_index(best.argmax(), best.shape)
        parent[outside[j]] = inside[i]
        inside.append(outside[j])
    return parent


def vote_matrix(votes: np.ndarray, m: int) -> np.ndarray:
    return (votes[:, None] >> np.arange(m)) & 1


#: Expected counts are summed in steps of 2^-20.
STEP = 1 << 20


def expected_counts(patterns: DataFrame, m: int, seeds: int, model: LabelModel | None) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, sizes) by class over the vote patterns (votes, toxic, n); known classes count
    as they are, others by the model's posterior (at first: whether a lexicon in ``seeds`` fires)."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False)
            known = np.array([-1 if t is None else int(t) for t in batch.column(1).to_pylist()])
            n = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            v = vote_matrix(raw, m)
            p = np.where(raw & seeds != 0, 0.9, 0.05) if model is None else model.posterior(v)
            p = np.where(known >= 0, known, p)
            values = []
            for w in (n * (1 - p), n * p):
                whole = np.rint(w * STEP)
                values.append(np.append(((v.T * whole) @ v).ravel(), whole.sum()))
            values = np.concatenate(values).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    got = patterns.mapInArrow(sums, "at long, value long").groupBy("at").agg(F.sum("value").alias("value")).collect()  # 2 * (m * m + 1) rows
    flat = np.zeros(2 * (m * m + 1))
    for r in got:
        flat[r["at"]] = r["value"] / STEP
    flat = flat.reshape(2, -1)
    return flat[:, :-1].reshape(2, m, m), flat[:, -1]


def label_model(patterns: DataFrame, lexicon: Lexicon, rounds: int = EM_ROUNDS) -> LabelModel:
    """Expectation maximisation: first with independent voters, then with their tree. The
    prior is the toxic share of the labels (a tenth where there is none)."""
    m = len(lexicon.voters)
    labelled, toxic = patterns.filter("toxic IS NOT NULL").agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("toxic").cast("int")), F.lit(0))).first()
    prior, model = (toxic + 1) / (labelled + 10), None
    for k in range(rounds):
        model = LabelModel.fit(*expected_counts(patterns, m, lexicon.insults(), model), prior, tree=k >= rounds // 3)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    known = known_labels(labels)
    lexicon = mine(docs, known)
    m = len(lexicon.voters)
    read = staged(read_texts(docs, lexicon), "toxic-read")
    result = ["doc_id", (~F.col("train")).alias("held_out")]

    marked = read.filter("train").join(broadcast_if_small(known), "doc_id", "left")
    patterns = staged(marked.groupBy("votes", "toxic").agg(F.count(F.lit(1)).alias("n")), "toxic-patterns")
    if patterns.isEmpty():  # nothing to learn from
        score = F.lit(0.0)
        return read.select(*result, score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
    model = label_model(patterns, lexicon)

    def posteriors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.posterior(vote_matrix(batch.column(0).to_numpy(zero_copy_only=False), m))
            toxic = [x if t is None else float(t) for x, t in zip(p, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(toxic, pa.float64())], [*batch.schema.names, "p"])

    believed = staged(patterns.mapInArrow(posteriors, "votes long, toxic boolean, n long, p double"), "toxic-posteriors")

    fired = F.filter(F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda k: F.when(
        F.col("votes").bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(m)]), k + 1)) != 0, F.concat(F.lit("v"), k))),
        lambda x: x.isNotNull())
    tokens = F.concat(F.transform("hits", lambda h: h.cast("string")), fired)
    vector = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(len(lexicon.entries))] + [f"v{k}" for k in range(m)], "tokens", "features")
    vector.setMinTF(1.0).setBinary(True)

    targets = marked.select("votes", "toxic", tokens.alias("tokens")).join(
        broadcast_if_small(believed.select(F.col("votes").alias("b_votes"), F.col("toxic").alias("b_toxic"), "p")),
        (F.col("votes") == F.col("b_votes")) & F.col("toxic").eqNullSafe(F.col("b_toxic")))
    grouped = targets.groupBy("tokens", "p").agg(F.count(F.lit(1)).alias("n"))
    weighted = staged(grouped.select("tokens", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("p") * F.col("n")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), ((1 - F.col("p")) * F.col("n")).alias("weight")))).alias("t"))
        .select("tokens", "t.*").filter("weight > 1e-9"), "toxic-targets")
    classifier = LogisticRegression(weightCol="weight", maxIter=40, regParam=1e-5, standardization=False).fit(vector.transform(weighted))

    scored = classifier.transform(vector.transform(read.select("doc_id", "train", tokens.alias("tokens"))))
    score = vector_to_array("probability")[1]
    return scored.select(*result, score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
