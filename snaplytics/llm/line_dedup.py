"""Line dedup by a segment-partition edit join, in DataFrame functions only.

All lines that are not blank take part. Lines with equal text are one class. Two classes of
at least ``MIN_CHARS`` code points (trimmed) are linked when their texts are within
``MAX_EDITS`` edits of code points, or, when both have at least ``MIN_WORDS`` words, within
``WORD_EDITS`` edits of words (so a long line with one word replaced, left out or added is
linked however long the word); shorter lines are compared for equality only. A line
stays when it is the first occurrence of its text (by document, then line number) and no
linked text occurs earlier.

The join, alike for code points and words as units: a line of l units is cut into
edits + 1 even segments; edits can touch all but
one, so a linked line of length l + d holds one segment unchanged, shifted by few places.
Every line enters its own segments (keyed by length, place and text) and probes, for each
shorter length within the threshold, the few substrings that the length-aware shift
bounds allow. Keys met by only one text are dropped by an aggregate that combines before
the shuffle, so a text that comes often is one entry of a key; only lines that share a key carry their text into the join, each text once, where the
edit distance is the join condition, so unverified pairs are never output: for code points
Spark's banded distance, cut off at the threshold, after letter counts; for words the banded
bit-parallel ``within_edits``, after a banded distance over one letter a word.
A key that many texts share is split by the skew handling of the join.

Cases: a null or empty text has no lines and stays as it is; blank lines always
stay; equal lines inside one document count like any other repeat; lines of the same words
in other white space are no word edit apart; rows that repeat both
``doc_id`` and text are one document and share the verdicts; a null ``doc_id`` sorts last;
an empty table gives an empty result; extra columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP, GAP_CHARS, broadcast_if_small, last_staged, only_kept, staged, table, unclash

MAX_EDITS = 2
MIN_CHARS = 20          # shorter lines have no edit links
WORD_EDITS = 1
MIN_WORDS = 10          # lines of fewer words have no links by words
NOT_BLANK = 1           # code points of the shortest line that is deduplicated and reported
LETTERS = "etaonisr"    # letters counted to tell pairs apart before their distance is measured


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(segment, how much shorter the other line is, shift) of every key of a line: within the
    shifts that the edits before and after the segment allow."""
    return [(i, shorter, shift) for shorter in range(edits + 1) for i in range(edits + 1)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1)]


def with_keys(lines: DataFrame, edits: int, by_words: bool = False) -> DataFrame:
    """(line, size, h) -> key, own, line, h for all keys of each line, in code points or (with the
    columns ``flat`` and ``n_words``) in words; own marks its own
    segments. The probes are rows, not twelve expressions: one small projection that the JVM
    compiles, where an array of all keys makes a method too large for it. Code points are four bytes
    each, made once a line: a segment is then cut out without counting through the line from its start.
    Segments of words at an end of the line are cut from that end only."""
    specs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(d).alias("d"), F.lit(s).alias("s")) for i, d, s in probes(edits)])
    parts = edits + 1
    units, length = (F.col("flat"), F.col("n_words")) if by_words else (F.encode("line", "UTF-32"), F.shiftright(F.octet_length("units"), 2))
    rows = lines.withColumn("units", units).select("line", "h", "units", length.alias("length"), F.explode(specs).alias("p"))
    rows = rows.select("line", "h", "units", "length", (F.col("length") - F.col("p.d")).alias("target"), F.col("p.i").alias("i"), F.col("p.s").alias("s"),
                       ((F.col("p.d") == 0) & (F.col("p.s") == 0)).alias("own"))
    # even segments, the longer ones last
    longer = F.col("target") % parts
    small = ((F.col("target") - longer) / parts).cast("int")
    start = small * F.col("i") + F.greatest(F.lit(0), F.col("i") + longer - parts) + F.col("s") + 1
    size = small + (F.col("i") >= parts - longer).cast("int")
    if by_words:
        end = start + size - 1
        upto = F.when(end >= F.col("length"), F.col("units")).otherwise(F.call_function("substring_index", F.col("units"), F.lit(" "), end))
        piece = F.when(start == 1, upto).otherwise(F.call_function("substring_index", upto, F.lit(" "), -size))
    else:
        piece = F.substring(F.col("units"), start * 4 - F.when(start > 0, 3).otherwise(0), size * 4)
    return rows.select(F.xxhash64(piece, F.col("i"), F.col("target")).alias("key"), "own", "line", "h")


def spaced(line: Column) -> Column:
    """Whether a line has white space besides single spaces between its words; most have none, which is found without a pattern."""
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for gap in ("  ", *GAP_CHARS.replace(" ", "")):
        odd = odd | F.contains(line, F.lit(gap))
    return odd


def flat(line: Column, odd: Column | None = None) -> Column:
    """A line's words with one space between them; odd: its ``spaced``, where that is known."""
    odd = spaced(line) if odd is None else odd
    return F.when(odd, F.regexp_replace(F.btrim(line, F.lit(GAP_CHARS)), GAP, " ")).otherwise(line)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two arrays are at most ``edits`` edits apart: banded and bit-parallel.

    Row d holds 2 * edits + 1 bits; after j items of b, its bit t says that the first
    j + t - edits items of a are within d edits of them. Items past either end of a match nothing.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    masks = F.transform(b, lambda item, j: sum(
        (F.when(F.get(a, j + (t - edits)) == item, F.lit(1 << t)).otherwise(F.lit(0)) for t in range(1, width)),
        F.when(F.get(a, j - edits) == item, F.lit(1)).otherwise(F.lit(0))))

    def step(rows: Column, same: Column) -> Column:
        new = [rows["r0"].bitwiseAND(same)]
        for d in range(1, edits + 1):
            old = rows[f"r{d - 1}"]
            changed = old.bitwiseOR(F.shiftright(old, 1)).bitwiseOR(F.shiftleft(new[-1], 1).bitwiseAND(F.lit(full)))
            new.append(rows[f"r{d}"].bitwiseAND(same).bitwiseOR(changed))
        return F.struct(*[r.alias(f"r{d}") for d, r in enumerate(new)])

    start = F.struct(*[F.lit(((1 << (d + 1)) - 1) << edits).alias(f"r{d}") for d in range(edits + 1)])
    end = F.aggregate(masks, start, step)[f"r{edits}"]
    apart = F.size(a) - F.size(b)
    return (F.abs(apart) <= edits) & (F.getbit(end, F.greatest(F.lit(0), F.least(F.lit(width - 1), apart + edits))) == 1)


def order_of(doc: Column, text_hash: Column, line_no: Column) -> Column:
    return F.struct(doc.isNull().alias("missing"), doc.alias("doc_id"), text_hash.alias("text_hash"), line_no.alias("line_no"))


def line_rows(docs: DataFrame, shortest: int = MIN_CHARS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, line_no, text_id (digest), chars (code points, trimmed) of every line of at least ``shortest`` code points;
    with line, h (64-bit hash), odd (``spaced``) and n_words for those that may have links."""
    line = F.col("line")
    edge = F.lit(False)
    for gap in GAP_CHARS:
        edge = edge | F.startswith(line, F.lit(gap)) | F.endswith(line, F.lit(gap))
    chars = F.length(F.when(edge, F.btrim(line, F.lit(GAP_CHARS))).otherwise(line))
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.filter(chars >= shortest).withColumn("odd", spaced(line))
    words = flat(line, F.col("odd"))
    spaces = F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" ")))
    may = chars >= min_chars
    return lines.select("doc_id", "text_hash", "line_no", digest(line).alias("text_id"), chars.alias("chars"), F.when(may, line).alias("line"),
                        F.xxhash64("line").alias("h"), "odd", F.when(may, spaces + 1).alias("n_words"))


def sharing(lines: DataFrame, edits: int, name: str, by_words: bool = False) -> DataFrame:
    """key, own, line of the keys that different texts share, one of them by its own segment."""
    keyed = with_keys(lines, edits, by_words)
    met = keyed.groupBy("key").agg(
        F.min("h").alias("least"), F.max("h").alias("most"), F.max("own").alias("own"))
    met = staged(met.filter((F.col("least") != F.col("most")) & F.col("own")).select(F.col("key").alias("m_key")), f"{name}-keys")
    side, same = broadcast_if_small(met), F.col("key") == F.col("m_key")
    if side is not met:
        return keyed.join(side, same, "left_semi").select("key", "own", "line").distinct()
    # too many keys to send around: found by the lines' hashes, so that no text is shuffled with each of its keys
    marks = staged(keyed.select("key", "own", "h").join(met, same, "left_semi").distinct(), f"{name}-marks")
    texts = lines.select("h", "line").join(marks.select("h").distinct(), "h", "left_semi").distinct()
    return marks.join(texts, "h").select("key", "own", "line").distinct()


def joined(near: DataFrame, close: Callable[[str, str], Column]) -> DataFrame:
    """a, b (digests) of the texts that share a key and are close, the first by its own segment; of pairs that share
    own segments one direction."""
    cells = [c for c in near.columns if c not in ("key", "own")]
    own = near.filter("own").select("key", *[F.col(c).alias(f"a_{c}") for c in cells])
    probe = near.select(F.col("key").alias("p_key"), F.col("own").alias("b_own"), *[F.col(c).alias(f"b_{c}") for c in cells])
    # two own segments meet from either side: measured once
    apart = (F.col("a_id") < F.col("b_id")) | (~F.col("b_own") & (F.col("a_id") != F.col("b_id")))
    found = own.join(probe.hint("merge"), (F.col("key") == F.col("p_key")) & apart & close("a_", "b_"))
    return found.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))


def links_by_characters(lines: DataFrame, edits: int) -> DataFrame:
    near = sharing(lines, edits, "line")
    # an edit changes at most two letter counts by one, so far pairs are told apart without a distance
    near = near.select("key", "own", "line", digest(F.col("line")).alias("id"), *[
        (F.length("line") - F.length(F.replace("line", F.lit(c)))).alias(f"n{i}") for i, c in enumerate(LETTERS)])

    def close(a: str, b: str) -> Column:
        apart = sum((F.abs(F.col(f"{a}n{i}") - F.col(f"{b}n{i}")) for i in range(1, len(LETTERS))), F.abs(F.col(f"{a}n0") - F.col(f"{b}n0")))
        return (apart <= 2 * edits) & (F.levenshtein(f"{a}line", f"{b}line", edits) >= 0)

    return joined(staged(near, "line-candidates"), close)


def links_by_words(lines: DataFrame, edits: int, min_words: int) -> DataFrame:
    lines = lines.filter(F.col("n_words") >= min_words).withColumn("flat", flat(F.col("line"), F.col("odd")))
    near = sharing(lines, edits, "word", by_words=True).withColumn("flat", flat(F.col("line")))
    # one letter a word, of 256: a distance over letters is never above the one over words
    letters = F.array_join(F.transform(F.split("flat", " "), lambda w: F.char(F.pmod(F.xxhash64(w), F.lit(256)))), "")
    near = near.select("key", "own", digest(F.col("line")).alias("id"), "flat", letters.alias("letters"))

    def close(a: str, b: str) -> Column:
        # a pair bound to a name, so that its texts are split once
        pair = F.struct(F.split(f"{a}flat", " ").alias("a"), F.split(f"{b}flat", " ").alias("b"))
        return (F.levenshtein(f"{a}letters", f"{b}letters", edits) >= 0) & F.exists(
            F.array(pair), lambda x: within_edits(x["a"], x["b"], edits))

    return joined(staged(near, "word-candidates"), close)


def line_links(lines: DataFrame, edits: int = MAX_EDITS, word_edits: int = WORD_EDITS, min_words: int = MIN_WORDS) -> DataFrame:
    """(a, b) for every ordered pair of different texts of ``line_rows`` within ``edits`` edits of code points, or of at
    least ``min_words`` words each and within ``word_edits`` edits of words, by text digest."""
    with only_kept(lines.sparkSession) as kept:
        found = links_by_characters(lines, edits).unionByName(links_by_words(lines, word_edits, min_words))
        found = staged(found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "line-links")
        kept.append(last_staged())
    return found


def digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def line_report(docs: DataFrame, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, shortest: int = MIN_CHARS) -> DataFrame:
    """Every line of at least ``shortest`` code points (links need ``min_chars``): doc_id, text_hash, line_no, first (place of the first occurrence of
    its text), n_links (different texts within the threshold), kept."""
    rows = staged(line_rows(docs, min(shortest, min_chars), min_chars), "line-rows")
    found = line_links(rows.filter(F.col("chars") >= min_chars).select("line", "h", "odd", "n_words"), edits)
    lines = rows.filter(F.col("chars") >= shortest).select("doc_id", "text_hash", "line_no", "text_id")
    place = order_of(F.col("doc_id"), F.col("text_hash"), F.col("line_no"))
    # staged, so that the join below reads both sides through a shuffle and can split a hot line
    first = staged(lines.groupBy("text_id").agg(F.min(place).alias("first")), "line-first")
    linked = found.groupBy(F.col("a").alias("text_id")).agg(F.count(F.lit(1)).alias("n_links"))
    linked = staged(first.join(linked, "text_id"), "line-linked")
    # the earliest place among a text's links
    ends = found.join(linked.select(F.col("text_id").alias("b"), F.col("first").alias("b_first")), "b")
    earliest = ends.groupBy(F.col("a").alias("text_id")).agg(F.min("b_first").alias("earliest"))
    linked = staged(linked.join(earliest, "text_id").select(
        F.col("text_id").alias("l_id"), "n_links", (F.col("earliest") < F.col("first")).alias("late")), "line-late")
    out = lines.join(first.withColumnRenamed("text_id", "f_id"), F.col("text_id") == F.col("f_id"))
    out = out.join(broadcast_if_small(linked), F.col("text_id") == F.col("l_id"), "left")
    kept = (place == F.col("first")) & ~F.coalesce("late", F.lit(False))
    return out.select("doc_id", "text_hash", "line_no", "first", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), kept.alias("kept"))


def dedup_lines(docs: DataFrame, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without the non-blank lines that ``line_report`` does not keep. All rows and columns stay."""
    n = unclash(docs, "gone_id", "gone_hash", "gone")
    with only_kept(docs.sparkSession) as kept:
        gone = line_report(docs, edits, min_chars, NOT_BLANK).filter(~F.col("kept")).groupBy("doc_id", "text_hash").agg(
            F.collect_set("line_no").alias("gone"))
        # no hint: a join that is broadcast up to some size would shuffle the texts beyond it, and so more than the input grows
        gone = staged(gone.toDF(n["gone_id"], n["gone_hash"], n["gone"]), "line-gone")
        kept.append(last_staged())
    same = F.col("doc_id").eqNullSafe(F.col(n["gone_id"])) & (F.xxhash64("text") == F.col(n["gone_hash"]))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col(n["gone"]), i)), "\n")
    out = docs.join(gone, same, "left").withColumn("text", F.when(F.col(n["gone"]).isNull(), F.col("text")).otherwise(left))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_report(table(spark, sf_dir, "documents"), shortest=NOT_BLANK)
    return rows.select("doc_id", "line_no", F.col("first.doc_id").alias("class_doc_id"), F.col("first.line_no").alias("class_line_no"),
                       "n_links", "kept")
