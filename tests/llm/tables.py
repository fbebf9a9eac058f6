"""Small tables with the awkward rows: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

WORDS = "the of and to in that it is was for on are with as they at be this from have or by".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "x", "ing", "ed"]) for _ in range(n))


def document_rows():
    rng = random.Random(5)
    rows = [(i, "\n".join(prose(rng, rng.randint(5, 40)) for _ in range(rng.randint(1, 6))), rng.choice(["en", "de"]), f"s{i % 4}")
            for i in range(1, 60)]
    base = prose(rng, 300)
    rows += [(60 + i, base[:-i] if i else base, "en", "s0") for i in range(4)]  # near copies
    rows += [(70, base.upper(), "en", "s1"), (71, base, "fr", "s1")]
    rows += [
        (80, None, "en", "s2"), (81, "", "en", None), (82, " \t\n\x0b\x0c\r ", None, None), (83, "one", None, "s9"),
        (None, "a text of no id at all, with more than twenty characters", "en", "s2"),
        (None, "another text of no id, also with more than twenty characters", None, "s2"),
        (84, "Ünïcode ÀÉ straße 漢字 😀 #*$ | <x>\n\nÜnïcode ÀÉ straße 漢字 😀 #*$ | <x>", "de", "s3"),
        (85, "a" * 30_000, "en", "s3"), (86, prose(rng, 20_000), "en", "s0"), (87, "spam eggs ham " * 400, "en", "s0"),
        (88, "repeated row here, long enough", "en", "s1"), (88, "repeated row here, long enough", "en", "s1"),
        (88, "same id, another text, long enough", "en", "s1"),
        (89, "line one is long enough to count\nline two is long enough to count", "en", "s1"),
        (90, "line one is long enough to coumt\nline 2 is long enough to count\nshort", "en", "s1"),
    ]
    return rows


DOCS = "doc_id bigint, text string, lang string, source string"
#: columns whose names the operators might use themselves
CLASH = ["size", "_size", "SIZE_", "key", "fp", "_fp", "words", "cell", "gone", "keep", "estimate", "p", "kept", "digest", "line", "k", "c"]


def documents(spark, extra=False, rows=None):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(document_rows() if rows is None else rows, DOCS)
    return df.withColumns({c: F.lit(7) for c in CLASH}) if extra else df


PAGES = "page_id bigint, url string, html string"


def page_rows():
    same = "<html><body><article><p>Same text &amp; more</p></article></body></html>"
    long = "<article>" + "<p>word ünï &lt;x&gt;</p>" * 3000 + "</article>"
    return [
        (1, "http://a.example.org/es/1?x#y", same), (2, "HTTP://A.Example.ORG/en/12", same), (3, "https://org", same),
        (4, None, None), (5, "no scheme here", ""), (6, "http://m.example.org/en/1", long), (None, "x://example.org/en/2", same),
        (7, "http://com/fr/", "<p>a\r\n\r\nWARC/1.1\r\nb</p>"), (8, "http://b.com/de/x\ny?z", "a"), (9, "http://b.com/de/", None),
        (10, "http://notexample.org/es/", "<p>unclosed"), (10, "http://notexample.org/es/", "<p>unclosed"),
        (11, "http://example.org?/es/", "<script>var x = '</p>';</script>"), (12, "http:///es/", "\x00\ud7ff"),
        (13, "ftp://blog.example.org:80/es/\U0010ffff", "<!-- only -->"),
    ]


def pages(spark, rows=None):
    return spark.createDataFrame(page_rows() if rows is None else rows, PAGES)


TURNS = "conv_id bigint, turn bigint, role string, text string"


def turn_rows():
    rng = random.Random(9)
    long = [("user" if k % 2 else "assistant", prose(rng, 6)) for k in range(70)]
    rows = []
    for c in range(-12, 80):
        if c in (10, 15, 25):  # a base that is absent
            continue
        shared = rng.choice([0, 1, 2, 5, 40, 70]) if c % 7 == 0 else rng.choice([0, 1, 2])
        own = rng.choice([1, 2, 9, 20]) if c % 9 == 0 else rng.randint(1, 4)
        turns = long[:shared] + [("user", rng.choice(["yes", "no", "", "ünï 漢字 😀"])) for _ in range(own)]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(1000 + k, 0, "system", "the same first turn") for k in range(150)]  # one path holds most conversations
    rows += [(2000, None, None, None), (2000, 0, "user", ""), (2000, 0, "user", ""), (2000, 0, "", "user"), (2000, 3, "a", "b" * 50_000)]
    rows += [(None, 0, "user", "of no conversation"), (3001, 0, "us", "er"), (3002, 0, "user", ""), (3003, 0, "", "user")]
    rng.shuffle(rows)
    return rows


def conversations(spark, extra=False, rows=None):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(turn_rows() if rows is None else rows, TURNS)
    return df.withColumns({c: F.lit(7) for c in ["key", "t1", "pos", "level", "node", "depth", "place", "block"]}) if extra else df


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
