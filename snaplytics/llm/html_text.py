"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks (``html_blocks``). A block's vector is made of
learned rows for the words of its tag path (tags, class, id and role words, hashed),
learned rows for its text's hashed words, and a few figures (length, share of link
text). A bidirectional LSTM in numpy reads the whole sequence, so each block is labelled
with the page around it known; the blocks labelled as content are joined.

Training: at most ``SAMPLE_PAGES`` pages (least hashes of ``page_id``, html of at most
``SAMPLE_CHARS`` characters, the first ``SAMPLE_BLOCKS`` blocks) are labelled by their markup
(``weak_label``); copies of them with the article's container renamed and boilerplate of
many kinds put in, whose labels are known by construction, teach the kinds of markup
that the sample lacks. The model has a fixed size and is sent to all tasks; every page
and every block is then labelled, whatever its length: time grows with a page's characters
and memory with its elements (paths are shared chains whose sums run along), and pages are
labelled together only as far as their cells, padding included, stay within ``CELLS_AT_ONCE``.

Cases: null or empty html gives an empty text; a page without blocks likewise; text
outside any container is content when the page has no article; repeated rows give
repeated rows; with no pages the model trains on nothing and the result is empty; extra
columns are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .html_blocks import Block, Leaf, page_blocks, page_leaves

SAMPLE_PAGES = 200
SAMPLE_CHARS = 100_000
SAMPLE_BLOCKS = 60
STEPS = 500
SEQUENCES = 24          # in a training step
PATH_ROWS, PATH_DIM = 1024, 16
WORD_ROWS, WORD_DIM = 2048, 8
FIGURES = 4
HIDDEN = 24
MEMO_WORDS = 200_000
#: Cells (blocks of the longest page x pages) that are labelled together, and blocks (or pages) held at once;
#: a page beyond either is handled alone.
CELLS_AT_ONCE = 32_768
BLOCKS_AT_ONCE, PAGES_AT_ONCE = 65_536, 512
STEPS_AT_ONCE = 1024

# Words of tag paths that mark boilerplate, and those that mark an article.
BOILERPLATE_TAGS = "nav header footer aside form button select textarea label dialog menu fieldset search".split()
BOILERPLATE_WORDS = """
ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice
notices notification alert popup modal overlay newsletter subscribe subscription signup sidebar side rail menu nav navbar
navigation breadcrumb breadcrumbs header masthead topbar footer foot contentinfo complementary comment comments reply
replies discussion respond disqus related recommended share sharing social widget toolbar pagination pager login search
copyright skip
""".split()
ARTICLE_WORDS = "article main .article .main .content .post .entry .story".split()
BOILERPLATE_PATHS = """
nav|nav ul li a|ul.menu li|div.menu ul li a|div.navigation|div.navbar ul li|header|header div|header h1|div.header|div.masthead p|
div.topbar|footer|footer p|div.footer|div.footer p|div.foot|aside|aside p|aside h2|aside ul li|div.sidebar|div.sidebar p|
div.side.rail ul li|section.related h2|section.related ul li a|div.recommended p|div.ad|div.ad p|div.ads|div.advert|
div.advertisement p|div.adsbygoogle|div.sponsored p|div.sponsor|div.banner|div.promo p|div.promotion|div.cookie.notice|
div.cookie.notice p|div.cookies p|div.consent p|div.gdpr|div.notice|p.notice|div.notices p|div.notification|div.alert|p.alert|
div.popup p|div.modal p|dialog p|div.overlay|form|form p|form label|form.search label|form button|div.newsletter p|
div.newsletter form label|div.subscribe p|div.subscription|div.signup|button|label|select option|fieldset legend|
section.comments h2|section.comments p|section.comments article p|section.comments article.comment p|div.comments div.comment p|
div.comments|ol.comment.list li p|ul.comments li|article.comment p|div.comment|div.reply p|div.replies div|div.discussion p|
div.respond p|div.disqus|div.share|div.sharing ul li|div.social ul li a|div.breadcrumbs|ol.breadcrumb li a|div.pagination a|
nav.pager a|div.widget p|div.toolbar|div.login p|div.search|div.copyright|p.copyright|a.skip|div.navigation ul li|
div.complementary p|div.contentinfo|search form label|menu li
""".replace("\n", "").split("|")
ARTICLE_PATHS = """
article|article|article|main|main article|main div|div.content|div.content article|div.post|div.post.content|div.entry.content|
div.article|div.article.body|div.story|div.story.body|section.article|div.main|section.content|section.story|
div.page div.content|div.wrapper main article|div.container article|div.layout div.main div.post
""".replace("\n", "").split("|")
LEAF_PATHS = "p p p p p h1 h2 h3 blockquote blockquote|p ul|li ol|li pre table|tr|td figure|figcaption div section|p section|h2".split()


def path_words(spec: str) -> list[str]:
    """'div.cookie.notice p' -> ['div', '.cookie', '.notice', 'p']."""
    return [w if i == 0 else "." + w for part in spec.split() for i, w in enumerate(part.split("."))]


def weak_label(path: tuple[str, ...], has_article: bool) -> int:
    """1 for content: inside an article's container (if the page has one), outside boilerplate."""
    if any(w in _BOILERPLATE for w in path):
        return 0
    return int(not has_article or any(w in _ARTICLE for w in path))


_BOILERPLATE = frozenset([*BOILERPLATE_TAGS, *("." + w for w in BOILERPLATE_WORDS)])
_ARTICLE = frozenset(ARTICLE_WORDS)


# ---- vectors --------------------------------------------------------------------------


class Vectors:
    """Row numbers and figures of blocks; remembers the rows of words it has seen."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def word_rows(self, text: str) -> list[int]:
        memo, out = self.memo, []
        for w in text.split(" "):
            row = memo.get(w)
            if row is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                row = memo[w] = zlib.crc32(w.lower().encode()) % WORD_ROWS
            out.append(row)
        return out

    def path_rows(self, path) -> list[int]:
        return [zlib.crc32(w.encode()) % PATH_ROWS for w in ("^", *path)]  # the root: text may lie outside any element

    def figures(self, text: str, words: int, link_chars: int) -> list[float]:
        size = len(text)
        return [np.log1p(size) / 5, min(1.0, link_chars / size), size / words / 10, float(text[-1] in ".!?")]

    def of(self, block: Block) -> tuple[list[int], list[int], list[float]]:
        words = self.word_rows(block.text)
        return self.path_rows(block.path), words, self.figures(block.text, len(words), block.link_chars)


def leaf_vectors(leaves: list[Leaf], vectors: Vectors, model: dict[str, np.ndarray]) -> np.ndarray:
    """(block, vector) of a page. An element's path sum is its parent's and its own words' rows."""
    root = model["path"][vectors.path_rows(())[0]]
    for leaf in leaves:
        waiting, at = [], leaf.element
        while at is not None and at.sum is None:
            waiting.append(at)
            at = at.parent
        for e in reversed(waiting):
            e.sum = (root if e.parent is None else e.parent.sum) + model["path"][vectors.path_rows(e.words)[1:]].sum(axis=0)
    x = np.empty((len(leaves), PATH_DIM + WORD_DIM + FIGURES), np.float32)
    words = [vectors.word_rows(leaf.text) for leaf in leaves]
    sizes = np.array([len(w) for w in words])
    rows = np.concatenate([np.asarray(w, np.int64) for w in words])
    x[:, :PATH_DIM] = [root if leaf.element is None else leaf.element.sum for leaf in leaves]
    x[:, PATH_DIM:PATH_DIM + WORD_DIM] = np.add.reduceat(model["word"][rows], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0) / sizes[:, None]
    x[:, PATH_DIM + WORD_DIM:] = [vectors.figures(leaf.text, n, leaf.link_chars) for leaf, n in zip(leaves, sizes)]
    return x


def padded(pages: list[list[tuple]], model: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, page, vector) and the mask of real blocks."""
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), PATH_DIM + WORD_DIM + FIGURES), np.float32)
    mask = np.zeros((longest, len(pages), 1), np.float32)
    flat = [(t, p, b) for p, page in enumerate(pages) for t, b in enumerate(page)]
    for column, name, which, scale in ((0, "path", 0, False), (PATH_DIM, "word", 1, True)):
        sizes = np.array([len(b[which]) for _, _, b in flat])
        rows = np.concatenate([np.asarray(b[which], np.int64) for _, _, b in flat])
        sums = np.add.reduceat(model[name][rows], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
        if scale:
            sums = sums / sizes[:, None]
        x[[t for t, _, _ in flat], [p for _, p, _ in flat], column:column + sums.shape[1]] = sums
    for t, p, b in flat:
        x[t, p, PATH_DIM + WORD_DIM:] = b[2]
        mask[t, p] = 1
    return x, mask


# ---- bidirectional LSTM ----------------------------------------------------------------


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def new_model(rng: np.random.Generator) -> dict[str, np.ndarray]:
    wide = PATH_DIM + WORD_DIM + FIGURES
    model = {"path": rng.normal(0, 0.3, (PATH_ROWS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_ROWS, WORD_DIM)),
             "out": rng.normal(0, 0.2, (2 * HIDDEN, 1)), "out_b": np.zeros(1)}
    for d in "fb":
        model |= {f"{d}x": rng.normal(0, wide ** -0.5, (wide, 4 * HIDDEN)), f"{d}h": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN)),
                  f"{d}b": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)}
    return {k: v.astype(np.float32) for k, v in model.items()}


def run_direction(model, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states of one direction; gates: input, forget, output, candidate."""
    steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
    pre = x @ model[d + "x"] + model[d + "b"]
    h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
    out = np.zeros((*x.shape[:2], HIDDEN), np.float32)
    for t in steps:
        z = pre[t] + h @ model[d + "h"]
        gates, g = sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        c_new = f * c + i * g
        tanh_c = np.tanh(c_new)
        if keep is not None:
            keep.append((t, h, c, i, f, o, g, tanh_c))
        m = mask[t]
        c = m * c_new + (1 - m) * c
        h = m * (o * tanh_c) + (1 - m) * h
        out[t] = h
    return out


def back_direction(model, d: str, x, mask, kept, dout, grads) -> np.ndarray:
    """Adds the direction's gradients; returns that of x."""
    dx = np.zeros_like(x)
    dh_next = np.zeros((x.shape[1], HIDDEN), np.float32)
    dc_next = np.zeros_like(dh_next)
    for t, h, c, i, f, o, g, tanh_c in reversed(kept):
        m = mask[t]
        dh = dout[t] + dh_next
        dh_new, dh_skip = m * dh, (1 - m) * dh
        dc_new = m * dc_next + dh_new * o * (1 - tanh_c ** 2)
        dz = np.concatenate([dc_new * g * i * (1 - i), dc_new * c * f * (1 - f), dh_new * tanh_c * o * (1 - o), dc_new * i * (1 - g ** 2)], axis=1)
        grads[d + "x"] += x[t].T @ dz
        grads[d + "h"] += h.T @ dz
        grads[d + "b"] += dz.sum(axis=0)
        dx[t] += dz @ model[d + "x"].T
        dh_next = dz @ model[d + "h"].T + dh_skip
        dc_next = dc_new * f + (1 - m) * dc_next
    return dx


def content_odds(model, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(time, page) log odds of content; both directions take their steps together."""
    steps, pages = x.shape[:2]
    back, back_mask = x[::-1], mask[::-1]
    inner = np.stack([model["fh"], model["bh"]])
    whole = bool(mask.all())
    states = np.empty((steps, 2, pages, HIDDEN), np.float32)
    h = c = np.zeros((2, pages, HIDDEN), np.float32)
    for t in range(steps):
        if t % STEPS_AT_ONCE == 0:  # what the input adds, for the next steps
            some = slice(t, t + STEPS_AT_ONCE)
            pre = np.stack([x[some] @ model["fx"] + model["fb"], back[some] @ model["bx"] + model["bb"]], axis=1)
        z = pre[t % STEPS_AT_ONCE] + h @ inner
        gates = sigmoid(z[..., :3 * HIDDEN])
        c_new = gates[..., HIDDEN:2 * HIDDEN] * c + gates[..., :HIDDEN] * np.tanh(z[..., 3 * HIDDEN:])
        h_new = gates[..., 2 * HIDDEN:] * np.tanh(c_new)
        if whole:
            c, h = c_new, h_new
        else:
            m = np.stack([mask[t], back_mask[t]])
            c, h = m * c_new + (1 - m) * c, m * h_new + (1 - m) * h
        states[t] = h
    out = model["out"]
    return (states[:, 0] @ out[:HIDDEN] + states[::-1, 1] @ out[HIDDEN:] + model["out_b"])[:, :, 0]


def gradients(model, pages: list[list[tuple]], labels: list[list[int]]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over the blocks and its gradients."""
    x, mask = padded(pages, model)
    kept = {"f": [], "b": []}
    h = np.concatenate([run_direction(model, d, x, mask, kept[d]) for d in "fb"], axis=2)
    p = sigmoid((h @ model["out"] + model["out_b"])[:, :, 0])
    y = np.zeros_like(p)
    for j, page in enumerate(labels):
        y[:len(page), j] = page
    m, n = mask[:, :, 0], mask.sum()
    loss = -float((m * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / n)
    dz = ((p - y) * m / n)[:, :, None].astype(np.float32)
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    grads["out"] += np.tensordot(h, dz, axes=([0, 1], [0, 1]))
    grads["out_b"] += dz.sum()
    dh = dz @ model["out"].T
    dx = sum(back_direction(model, d, x, mask, kept[d], dh[:, :, k * HIDDEN:(k + 1) * HIDDEN], grads) for k, d in enumerate("fb"))
    for j, page in enumerate(pages):
        for t, (path, words, _) in enumerate(page):
            np.add.at(grads["path"], path, dx[t, j, :PATH_DIM])
            np.add.at(grads["word"], words, dx[t, j, PATH_DIM:PATH_DIM + WORD_DIM] / len(words))
    return loss, grads


# ---- training -----------------------------------------------------------------------------


def varied(blocks: list[Block], labels: list[int], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A page's blocks in another article container, with boilerplate put in."""
    pick = lambda some: some[int(rng.integers(len(some)))]
    texts = [b.text for b in blocks]
    container = path_words(pick(ARTICLE_PATHS))
    if rng.random() < 0.1:
        container = []  # a page without any article container: its plain blocks are content
    kept = [b for b, y in zip(blocks, labels) if y]
    rest = [b for b, y in zip(blocks, labels) if not y]
    new: list[tuple[Block, int]] = []

    def boilerplate(inside: list[str]) -> list[tuple[Block, int]]:
        path, out = path_words(pick(BOILERPLATE_PATHS)), []
        for _ in range(int(rng.integers(1, 5))):
            words = pick(texts).split(" ")
            at = int(rng.integers(len(words)))
            text = " ".join(words[at:at + int(rng.integers(1, 40))])
            out.append((Block(("html", "body", *inside, *path), text, len(text) if "a" in path else 0), 0))
        return out

    if rng.random() < 0.5:
        new += [(b, 0) for b in rest if rng.random() < 0.8 and container]
    while rng.random() < 0.6:
        new += boilerplate([])
    for b in kept:
        leaf = [w for part in pick(LEAF_PATHS).split("|") for w in path_words(part)] if rng.random() < 0.5 else [b.path[-1]]
        if leaf[0].startswith(".") or leaf[0] in ("b", "i", "a", "span"):
            leaf = ["p"]
        new.append((Block(("html", "body", *container, *leaf), b.text, b.link_chars), 1))
        if rng.random() < 0.12:
            new += boilerplate(container)
    while rng.random() < 0.6:
        new += boilerplate([])
    if container and rng.random() < 0.3:  # loose text beside the article is none of it
        new.append((Block(("html", "body", "div"), pick(texts)[:200], 0), 0))
    new = new[:SAMPLE_BLOCKS]
    return [b for b, _ in new], [y for _, y in new]


def train(pages: list[list[Block]], steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the labeller with Adam on the sample and its varied copies."""
    rng = np.random.default_rng(seed)
    model, vectors = new_model(rng), Vectors()
    pages = [p[:SAMPLE_BLOCKS] for p in pages if p]
    if not pages:
        return model
    labelled = [[weak_label(b.path, any(w in _ARTICLE for c in p for w in c.path)) for b in p] for p in pages]
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(1, steps + 1):
        some, wanted = [], []
        for i in rng.integers(len(pages), size=SEQUENCES):
            blocks, labels = pages[i], labelled[i]
            if rng.random() < 0.7:
                blocks, labels = varied(blocks, labels, rng)
            if blocks:
                some.append([vectors.of(b) for b in blocks])
                wanted.append(labels)
        _, grads = gradients(model, some, wanted)
        rate = 0.01 * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            model[k] = model[k] - (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return model


# ---- pages ------------------------------------------------------------------------------------


def label_together(model, vectors: Vectors, pages: list[list[Leaf]]) -> list[list[bool]]:
    """Whether each block of each page is content."""
    out: list[list[bool]] = [[] for _ in pages]
    full = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    while full:
        longest, some = len(pages[full[-1]]), []
        while full and (not some or longest * (len(some) + 1) <= CELLS_AT_ONCE):
            some.append(full.pop())
        x = np.zeros((longest, len(some), PATH_DIM + WORD_DIM + FIGURES), np.float32)
        mask = np.zeros((longest, len(some), 1), np.float32)
        for j, i in enumerate(some):
            x[:len(pages[i]), j] = leaf_vectors(pages[i], vectors, model)
            mask[:len(pages[i]), j] = 1
        odds = content_odds(model, x, mask)
        for j, i in enumerate(some):
            out[i] = (odds[:len(pages[i]), j] > 0).tolist()
    return out


def main_texts(model, vectors: Vectors, htmls: list[str | None]) -> list[str]:
    """The main text of each page; no more than ``BLOCKS_AT_ONCE`` blocks, or one page's, are held."""
    out: list[str] = []
    held: list[list[Leaf]] = []

    def flush() -> None:
        for leaves, content in zip(held, label_together(model, vectors, held)):
            out.append("\n\n".join(leaf.text for leaf, y in zip(leaves, content) if y))
        held.clear()
    for html in htmls:
        leaves = page_leaves(html)
        if held and (sum(map(len, held)) + len(leaves) > BLOCKS_AT_ONCE or len(held) >= PAGES_AT_ONCE):
            flush()
        held.append(leaves)
    flush()
    return out


def training_sample(pages: DataFrame, size: int = SAMPLE_PAGES) -> list[list[Block]]:
    """The blocks of at most ``size`` pages, those with the least hashes. A threshold on the
    hash leaves about four times as many before they are sorted, so what the tasks send
    to the driver does not grow with their number."""
    n = pages.count()
    if not n:
        return []
    share = min(1.0, 4 * size / n)
    h = F.xxhash64("page_id", "url")
    some = pages.filter((h <= int((share - 0.5) * (2 ** 64 - 2))) if share < 1 else F.lit(True)).filter(F.length("html") <= SAMPLE_CHARS)
    rows = some.orderBy(h, "page_id", "url").limit(size).select("html").collect()
    return [page_blocks(r.html, SAMPLE_BLOCKS) for r in rows]


def extract_text(pages: DataFrame, model: dict[str, np.ndarray] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page; trains the labeller unless one is given."""
    model = model if model is not None else train(training_sample(pages))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # fixed size: about 0.2 MB

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                some = batch.slice(start, PAGES_AT_ONCE)
                texts = main_texts(shared.value, vectors, some.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "url", "html").mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars bigint")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
