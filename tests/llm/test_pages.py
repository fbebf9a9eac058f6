"""Page operators against plain Python, and the block labeller's held-out accuracy."""

import base64
import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snaplytics.llm import html_text, url_filter, warc
from snaplytics.llm.html_blocks import page_blocks

from .tables import page_rows, pages, rows_of

# ---- HTML


def test_blocks_of_awkward_markup():
    texts = lambda h: [b.text for b in page_blocks(h)]
    assert texts(None) == texts("") == texts("<!-- c --><script>var t='</p>'</script><style>p{}</style>") == []
    assert texts("plain &amp; simple") == ["plain & simple"]
    assert texts("<p><b>one<br>two<p>three  \n four</p>") == ["one two", "three four"]
    assert texts("<ul><li>a<li>b <i>c</i></ul><table><tr><td>x<td>y</table>") == ["a", "b c", "x", "y"]
    assert texts("<head><title>t</title><body><div>a<div>b</div>c</div></b></p>") == ["a", "b", "c"]
    assert texts("<p>&lt;b&gt; &#233; &eacute; &nbsp;x") == ["<b> é é x"]
    deep = page_blocks("<div class='A b' id=c3 role=main><p>x <a href=y>link</a></p></div>")[0]
    assert deep.path == ("div", ".a", ".b", ".c", ".main", "p") and deep.link_chars == 4
    assert len(texts("<p>a" * 5000)) == 5000


def naive_blocks(html):
    """The rules of the block parser with a plain stack that is walked each time."""
    from html.parser import HTMLParser

    from snaplytics.llm import html_blocks as hb

    class Naive(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.stack, self.out, self.text, self.links = [], [], [], 0

        def flush(self):
            text = " ".join("".join(self.text).split())
            if text:
                self.out.append((tuple(w for _, ws in self.stack for w in ws), text, self.links))
            self.text, self.links = [], 0

        def close_last(self, tags, boundary):
            for k in reversed(range(len(self.stack))):
                if self.stack[k][0] in tags:
                    del self.stack[k:]
                    return True
                if self.stack[k][0] in boundary:
                    return False
            return False

        def handle_starttag(self, tag, attrs):
            if tag == "br":
                self.text.append(" ")
                return
            if tag == "body":
                self.close_last(("head",), ())
            if tag in hb.BLOCK:
                self.flush()
                if not (tag in hb.CLOSES and self.close_last(*hb.CLOSES[tag])):
                    self.close_last(("p",), ("button", "table", "td", "th", "object"))
            if tag not in hb.VOID:
                words = [tag] + ["." + w for n, v in attrs if v and n in ("class", "id", "role") for w in hb.NAME.findall(v.lower())]
                self.stack.append((tag, words))

        def handle_startendtag(self, tag, attrs):
            self.handle_starttag(tag, attrs)

        def handle_endtag(self, tag):
            if tag in hb.VOID:
                return
            if tag in hb.BLOCK:
                self.flush()
            self.close_last((tag,), () if tag in hb.BLOCK or tag in hb.UNSEEN else hb.BLOCK)

        def handle_data(self, data):
            if not any(t in hb.UNSEEN for t, _ in self.stack):
                self.text.append(data)
                self.links += len(data) * any(t == "a" for t, _ in self.stack)

    parser = Naive()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.out


def random_html(rng):
    tags = "div p ul li ol table tr td th dl dt dd a b span section head body article svg template select option br hr h1 button form".split()
    out = []
    for _ in range(int(rng.integers(1, 60))):
        t = str(rng.choice(tags))
        kind = rng.random()
        out.append(f"<{t} class='{t}x y'>" if kind < 0.45 else f"</{t}>" if kind < 0.75 else f"<{t}/>" if kind < 0.78 else f" w{int(rng.integers(9))} &amp; ")
    return "".join(out)


def test_blocks_equal_a_naive_parser():
    rng = np.random.default_rng(4)
    for _ in range(1500):
        html = random_html(rng)
        assert [tuple(b) for b in page_blocks(html)] == naive_blocks(html), html


def test_labels_equal_one_page_at_a_time():
    """Pages labelled together, from running path sums and both directions in step, against each
    page alone with spelled-out paths and one direction after the other."""
    rng = np.random.default_rng(5)
    model = html_text.new_model(rng)
    htmls = [random_html(rng) for _ in range(150)] + [None, "", "<p>a" * 3000, "<div>" * 300 + "x"]
    vectors = html_text.Vectors()
    got = html_text.label_together(model, vectors, [html_text.page_leaves(h) for h in htmls])
    for html, labels in zip(htmls, got):
        blocks = page_blocks(html)
        if not blocks:
            assert labels == []
            continue
        x, mask = html_text.padded([[vectors.of(b) for b in blocks]], model)
        h = np.concatenate([html_text.run_direction(model, d, x, mask) for d in "fb"], axis=2)
        odds = (h @ model["out"] + model["out_b"])[:, 0, 0]
        assert all(y == (o > 0) or abs(o) < 1e-3 for y, o in zip(labels, odds))


def peak_mb(run):
    import tracemalloc
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


@pytest.mark.parametrize("html, blocks", [
    ("<div>x" * 20_000, 20_000), ("<div class='a b c'>" * 20_000 + "x", 1), ("<p>a</p>" * 200_000, 200_000),
    ("<b>" * 50_000 + "x" + "</i></p>" * 50_000, 1), ("<ul><li><table><tr><td>" * 5_000 + "y", 1)])
def test_deep_and_many_block_pages(html, blocks):
    import time
    model, vectors = html_text.new_model(np.random.default_rng(1)), html_text.Vectors()
    began = time.process_time()
    assert len(html_text.page_leaves(html)) == blocks
    html_text.main_texts(model, vectors, [html, *["<p>small</p>"] * 63])
    assert time.process_time() - began < 60
    if len(html) < 200_000:
        assert peak_mb(lambda: html_text.main_texts(model, vectors, [html, *["<p>small</p>"] * 63])) < 400


def made_page(i, rng):
    word = lambda: "".join(rng.choice(list("abcdefghij"), size=int(rng.integers(2, 9))))
    text = lambda n: " ".join(word() for _ in range(int(rng.integers(1, n)))).capitalize() + "."
    body = [text(12), *(text(60) for _ in range(int(rng.integers(1, 8))))]
    article = f"<h1>{body[0]}</h1>" + "".join(f"<p>{p}</p>" for p in body[1:])
    extra = ["<aside><p>{}</p></aside>", "<form><label>{}</label><input></form>", "<div class='cookie-notice'>{}</div>",
             "<section class=comments><p>{}</p></section>", "<div class=sidebar><p>{}</p></div>"]
    more = "".join(str(rng.choice(extra)).format(text(20)) for _ in range(int(rng.integers(0, 3))))
    html = (f"<html><head><title>{body[0]}</title></head><body><nav><ul>" + "".join(f"<li><a href=x>{word()}</a></li>" for _ in range(5))
            + f"</ul></nav><div class=ad>{text(10)}</div><article>{article}</article>{more}<footer>&copy; {text(8)}</footer></body></html>")
    return html, "\n\n".join(body)


def test_labeller_learns_the_markup_and_more():
    rng = np.random.default_rng(8)
    made = [made_page(i, rng) for i in range(90)]
    model = html_text.train([page_blocks(h) for h, _ in made[:40]], steps=220)
    got = html_text.main_texts(model, html_text.Vectors(), [h for h, _ in made[40:]])
    assert sum(g == want for g, (_, want) in zip(got, made[40:])) >= 48
    assert html_text.main_texts(model, html_text.Vectors(), [None, "", "<nav></nav>"]) == ["", "", ""]


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in html_text.new_model(rng).items()}
    vectors = html_text.Vectors()
    blocks = [[vectors.of(b) for b in page_blocks(f"<div class=a{i}><p>one two<p>three</div><p>{'x ' * i}y")] for i in range(1, 4)]
    labels = [[1, 0, 1], [0, 0, 1], [1, 1, 0]]
    _, grads = html_text.gradients(model, blocks, labels)
    for name in ("fh", "bx", "out", "fb"):
        flat, step = model[name].reshape(-1), 1e-3
        for at in rng.integers(flat.size, size=3):
            old = flat[at]
            flat[at] = old + step
            up, _ = html_text.gradients(model, blocks, labels)
            flat[at] = old - step
            down, _ = html_text.gradients(model, blocks, labels)
            flat[at] = old
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_extract_rows_and_empty_table(spark):
    rng = np.random.default_rng(3)
    model = html_text.new_model(rng)
    got = html_text.extract_text(pages(spark).withColumn("text", F.lit(1)), model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert rows_of(got, "page_id", "url") == sorted(((r[0], r[1]) for r in page_rows()), key=repr)
    assert got.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert html_text.extract_text(pages(spark, rows=[])).collect() == []


# ---- URL rules


def test_longest_rule_by_brute_force(spark):
    rng = np.random.default_rng(6)
    hosts = ["a", "b.a", "c.b.a", "d", "b.d", "xa", "a.d"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy", "/é", "/x/y/z"]
    rules = {(h, p): str(rng.choice(["allow", "block"])) for h in hosts[:5] for p in paths if rng.random() < 0.5}
    urls = [(i, f"http://{h.upper() if i % 3 == 0 else h}{p}{t}", None) for i, (h, p, t) in enumerate(
        (h, p, t) for h in [*hosts, "z.c.b.a"] for p in paths for t in ("", "?q=/x", "#f", "w"))]
    got = url_filter.filter_urls(pages(spark, urls), url_filter.rule_table(spark, [(v, h, p) for (h, p), v in rules.items()] * 2))
    for r in got.collect():
        fits = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in rules.items()
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        want = max(fits, default=(0, 0, None, "allow"))
        assert (r.rule, r.verdict) == want[2:], r
    assert got.count() == len(urls)


def test_hot_host_is_salted_and_rule_list_may_be_empty(spark):
    urls = [(i, f"http://hot.org/{i}", None) for i in range(3000)]
    got = url_filter.filter_urls(pages(spark, urls), url_filter.rule_table(spark, [("block", "org", "/1")]))
    assert got.filter("verdict = 'block'").count() == sum(str(i).startswith("1") for i in range(3000))
    none = url_filter.rule_table(spark, [])
    assert {(r.rule, r.verdict) for r in url_filter.filter_urls(pages(spark), none).collect()} == {(None, "allow")}


# ---- WARC


def test_archives_are_valid_and_resolved(spark, tmp_path):
    raw, done = f"{tmp_path}/raw", f"{tmp_path}/done"
    warc.archive_pages(pages(spark).repartition(3).withColumn("payload", F.lit(1)), raw)
    warc.resolve(spark, raw, done)
    records = {}
    for path in sorted(tmp_path.glob("done/*.gz")):
        data = gzip.decompress(path.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size:size + 4] == b"\r\n\r\n"
            assert fields["WARC-Record-ID"] not in records
            records[fields["WARC-Record-ID"]] = (fields, rest[:size])
            data = rest[size + 4:]
    assert len(records) == len(page_rows())
    for fields, block in records.values():
        if fields["WARC-Type"] == "revisit":
            to, body = records[fields["WARC-Refers-To"]]
            assert to["WARC-Type"] == "response" and to["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
            assert to["X-Page-ID"] == fields["X-Refers-To-Page-ID"] and block.endswith(b"\r\n\r\n")
        else:
            body = block.partition(b"\r\n\r\n")[2]
            assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    back = warc.read_archives(spark, done)
    html = {r[0]: (r[2] or "").encode() for r in page_rows()}
    responses = back.filter("record_type = 'response'").collect()
    assert all(bytes(r.payload) == html[r.page_id] for r in responses)
    assert sorted(set(html.values())) == sorted(bytes(r.payload) for r in responses)


def test_small_payloads_may_stay_responses(spark, tmp_path):
    raw = warc.archive_pages(pages(spark), f"{tmp_path}/raw")
    back = warc.read_archives(spark, warc.resolve(spark, raw, f"{tmp_path}/done", min_bytes=30))
    assert back.filter("payload_bytes < 30 and record_type = 'revisit'").count() == 0
    assert back.filter("payload_bytes >= 30 and record_type = 'revisit'").count() == 3


def test_broken_archives_are_refused():
    good = warc.make_record(1, "u", "body", "response", warc.payload_digest(b"body"), 4, "x") + warc.END
    assert [b for _, b in warc.parse_archive(gzip.compress(good.encode()) * 2)][1].endswith(b"\r\n\r\nbody")
    with pytest.raises(ValueError):
        list(warc.parse_archive(gzip.compress(good[:-10].encode())))
    with pytest.raises(ValueError):
        list(warc.parse_archive(gzip.compress(b"no record\r\n\r\n")))
