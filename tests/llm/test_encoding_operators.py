"""Page text, toxicity, packing and token counts: round trips, brute force and held-out accuracy."""

import random
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from namekin.llm import html_blocks, html_extract, packing, token_counts, tokenizers, toxicity
from tests.llm.conftest import odd_rows, prose

SF = "/root/testdata/sf0.01"


# Pages.

@pytest.fixture(scope="module")
def crf():
    sample = [f"<body><p>{prose(k, 20 + k)}</p><p>{prose(k, 4)}</p></body>" for k in range(20)]
    return html_extract.train(html_extract.labelled_pages(sample))


def test_blocks():
    page = (
        "<html><head><title>no</title><style>p{}</style><script>var t='</p>'; if (a<b) {}</script></head><body><!-- <p>no</p> -->"
        "<h1>A &amp; B</h1><p>one<b>two</b> three<br>four\n five &copy&nbsp;6<p>next<ul><li>x<li>y</ul><div>tail <!-- c -->end"
        "<noscript><p>no</p></noscript></div>rest"
    )
    assert [b.text for b in html_blocks.blocks(page)] == [
        "A & B", "onetwo three four five © 6", "next", "x", "y", "tail end", "rest",
    ]
    for odd in (None, "", "   ", "<", "<p", "<!--", "</p>", "<script>", "a < b & c", "<p><p><p>", "&#x41;&bogus;"):
        html_blocks.blocks(odd)
    assert html_blocks.blocks("plain text")[0].text == "plain text"


@pytest.mark.parametrize("page, want", [
    ("<article><p>a</p><svg/><p>b</p></article>", ["a", "b"]),
    ("<p>a</p><svg viewBox='0 0 1 1' /><p>b</p><svg><path d='x'/></svg><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><svg><svg/><style/><title>no</title><text>axis <tspan>x</tspan></text></svg><p>b</p>", ["a", "axis x", "b"]),
    ("<p>a</p><svg width=5/><p>b</p><svg><circle><p>c</p><div/>d", ["a", "b", "c", "d"]),
    ("<p>so <math/> if <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>, it holds</p>", ["so if x = 1 2, it holds"]),
    ("<p>(<math><semantics><mi>x</mi><annotation>no</annotation></semantics></math>)</p><p>b</p>", ["(x)", "b"]),
    ("<math><mtext><![CDATA[a<b &amp;]]></mtext></math><p>c</p>", ["a<b &amp;", "c"]),
    ("<object data=x><p>a</p></object><xmp>b <b> &amp; c</xmp>d", ["a", "b <b> &amp; c", "d"]),
    ("<textarea>a <p> &amp; b</textarea><select><option>c<option>d</select>e", ["a <p> & b", "c", "d", "e"]),
    ("<video>a</video><audio>b</audio><canvas>c</canvas><iframe>d</iframe><noframes><p>e</p></noframes>f", list("abcdef")),
    ("<p title=don't>a</p><p>it's b</p>", ["a", "it's b"]),
    ("<p \"odd>a</p><p>\"b\"</p><p title=\"x>y\" id = 'p>q'>c</p><p a==\"x>d", ["a", '"b"', "c", "d"]),
    ("<p title=\"a>b</p><p>c", ["b", "c"]),
    ("<!-->a<!--->b<!-- no --!>c<p>d <![CDATA[e", ["abc", "d"]),
    ("<template-box>a</template-box><template><template></template>no</template>b<title>no</title-x></title>c", ["a", "b", "c"]),
])
def test_blocks_lose_no_text(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


def test_main_text_after_an_empty_drawing(crf):
    page = "<article><p>{}</p><svg/><p title=don't>{}</p><math><mi>x</mi></math></article><footer>it's</footer>"
    p, q = prose(1, 40) + ".", prose(2, 40) + "."
    assert html_extract.main_text(page.format(p, q), crf) == f"{p} {q} x"


LAYOUTS = [
    ("<body><nav>{m}</nav><article><h1>{h}</h1><p>{p}</p><p>{q}</p></article><footer>{m}</footer></body>"),
    ("<body><div class='menu'>{m}</div><main><h1>{h}</h1><p>{p}</p><div>{q}</div></main><aside><p>{x}</p></aside></body>"),
    ("<body><div id='content'><h1>{h}</h1><p>{p}</p><p>{q}</p></div><div class='comments'><p>{x}</p></div></body>"),
    ("<body><div class='cookie banner'><p>{x}</p></div><article><h1>{h}</h1><p>{p}</p><p>{q}</p></article>"
     "<section id='comments'><p>{x}</p></section><form><p>{m}</p></form></body>"),
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_main_text_of_unseen_layouts(crf, layout):
    parts = {"m": "Home About", "h": "A title here", "p": prose(1, 60) + ".", "q": prose(2, 45) + ".", "x": prose(3, 30) + "."}
    assert html_extract.main_text(layout.format(**parts), crf) == " ".join(parts[k] for k in "hpq")


def test_decoding_is_the_best_path(crf):
    rng = np.random.default_rng(0)
    model = html_extract.Crf(rng.normal(size=html_extract.FEATURES), rng.normal(size=(2, 2)))
    for n in range(1, 9):
        page = [rng.integers(0, html_extract.FEATURES, 4).tolist() for _ in range(n)]
        scores = model.scores(page)

        def total(y):
            return sum(s for s, k in zip(scores, y) if k) + sum(model.pairs[a, b] for a, b in zip(y, y[1:]))

        best = max((tuple((m >> k) & 1 for k in range(n)) for m in range(1 << n)), key=total)
        assert abs(total(model.decode(page)) - total(best)) < 1e-9


def test_marginals_are_sums_over_all_paths():
    rng = np.random.default_rng(1)
    pairs, lengths = rng.normal(size=(2, 2)), [3, 1, 5, 5, 2]
    packed = html_extract._Packed(lengths)
    scores = rng.normal(size=sum(lengths))
    single, double = packed.marginals(scores, pairs)
    want_double = np.zeros((2, 2))
    for k, which in enumerate(packed.order):
        rows, total, ones = packed.rows(k), 0.0, np.zeros(lengths[which])
        twos = np.zeros((2, 2))
        assert len(rows) == lengths[which]
        for m in range(1 << len(rows)):
            y = [(m >> i) & 1 for i in range(len(rows))]
            p = np.exp(sum(scores[r] for r, v in zip(rows, y) if v) + sum(pairs[a, b] for a, b in zip(y, y[1:])))
            total += p
            ones += p * np.array(y)
            for a, b in zip(y, y[1:]):
                twos[a, b] += p
        assert np.allclose(single[rows], ones / total)
        want_double += twos / total
    assert np.allclose(double, want_double)


def test_training_takes_all_sampled_pages_and_blocks():
    few = html_extract.labelled_pages([])
    pages = [f"<article><p>p{k}.</p></article>" for k in range(150)]
    pages.append("<article>" + "".join(f"<p>b{k}.</p>" for k in range(500)) + "</article><footer>end</footer>")
    out = html_extract.labelled_pages(pages)[len(few):]
    assert len(out) == 153 and sum(len(p) for p, _ in out) == 651
    assert all(len(p) == len(y) <= html_extract.STRETCH for p, y in out)
    assert sum(sum(y) for _, y in out) == 650 and out[-1][1][-1] == 0


def test_layout_that_sorts_last_is_learned():
    pages = [f"<article><p>{prose(k, 30)}.</p></article>" for k in range(100)]
    late = "<main class=zz><p>{}.</p><div class=zzaside><aside><p>{}.</p></aside></div></main>"
    pages += [late.format(prose(k, 30), prose(200 + k, 30)) for k in range(100)]
    crf = html_extract.train(html_extract.labelled_pages(pages))
    assert crf.weights[html_extract._feature("name:zz")] != 0


def test_pages_of_all_kinds(spark, crf):
    rows = [(1, "u", "<article><p>text here</p></article>", "x"), (None, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(pages, crf).collect()
    assert sorted(r["text"] for r in got) == ["", "", "", "text here"]
    assert html_extract.extract(pages.limit(0), html_extract.Crf(np.zeros(html_extract.FEATURES), np.zeros((2, 2)))).count() == 0


# Toxicity.

def plain_segments(scores):
    """Maximal scoring segments by their definition: take the best run, then go left and right."""
    best, at = 0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > best + 1e-12:
                best, at = s, (a, b)
    if at is None:
        return []
    a, b = at
    right = [(x + b, y + b, s) for x, y, s in plain_segments(scores[b:])]
    return plain_segments(scores[:a]) + [(a, b, best)] + right


def test_segments():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.choice([-0.5, -0.25, 1.0, 2.5, -3.0]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = toxicity.segments(np.array(scores))
        want = plain_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def made_up(n=600):
    rng = random.Random(8)
    docs, labels = [], []
    for k in range(n):
        words = prose(k, rng.randint(20, 200)).split()
        toxic = k % 8 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(["vile", "awful", "Horrid!", "nasty"]) for _ in range(5)]
        docs.append((k, " ".join(words)))
        if k % 2 == 0:
            labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = made_up()
    frame = spark.createDataFrame([*docs, (None, "x"), (9001, None), (9002, ""), docs[0]], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.score(frame, toxicity.fit(frame, marks)).collect()
    assert len(got) == len(docs) + 4
    by = {r["doc_id"]: r["score"] for r in got}
    assert all((by[k] >= 0.7) == (k % 8 == 0) for k, _ in docs)
    assert all(0 <= r["score"] <= 1 for r in got) and by[9001] == by[9002] < 0.5
    passages = {r["doc_id"]: r["passages"] for r in got}
    assert passages[8] and not passages[9]


def test_no_labels(spark, no_docs):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, labels)).first()["score"] == 0.0
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels.limit(0))).count() == 0


# Packing.

def test_best_fit_places_every_piece_once():
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 200))]
        rows = packing.best_fit(sizes, 64)
        assert sorted(k for r in rows for k in r) == list(range(len(sizes)))
        assert all(sum(sizes[k] for k in r) <= 64 for r in rows)
        # brute-force best fit decreasing needs as many rows
        room = []
        for s in sorted(sizes, reverse=True):
            fits = [k for k, free in enumerate(room) if free >= s]
            if fits:
                room[min(fits, key=lambda k: room[k])] -= s
            else:
                room.append(64 - s)
        assert len(rows) == len(room)


@pytest.mark.parametrize("buffer_tokens", [8_000_000, 500])
def test_packs_hold_every_document(spark, odd, no_docs, buffer_tokens):
    data = tokenizers.vocabulary(tokenizers.BYTE_BPE)
    encoder, end = tokenizers.byte_encoder(data), tokenizers.end_mark(data)
    packs = packing.pack(odd, length=256, buffer_tokens=buffer_tokens).collect()
    assert len({p["pack_id"] for p in packs}) == len(packs)
    found: dict = {}
    for p in packs:
        ids, at = (struct.unpack("<256H", bytes(p[c])) for c in ("ids", "positions"))
        cuts = p["cu_seqlens"]
        assert cuts[0] == 0 and cuts[-1] == p["n_tokens"] <= 256 and set(ids[cuts[-1] :]) <= {end}
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            assert at[a:b] == tuple(range(b - a))
            found.setdefault(p["doc_ids"][k], []).append((p["doc_starts"][k], ids[a:b]))
    want: dict = {}
    for i, t in odd_rows():
        want.setdefault(i, []).append(tuple(encoder.encode_ordinary(t or "")) + (end,))
    for i, texts in want.items():
        assert sum(len(x) for _, x in found[i]) == sum(map(len, texts))
        if len(texts) == 1:
            assert tuple(x for _, part in sorted(found[i]) for x in part) == texts[0]
    assert set(found) == set(want)
    assert packing.pack(no_docs).count() == 0


# Token counts.

def test_every_limit(spark, odd, no_docs):
    encoder = tokenizers.byte_encoder(tokenizers.vocabulary(tokenizers.BYTE_BPE))
    lengths = [len(encoder.encode_ordinary(t or "")) for _, t in odd_rows()]
    counted = token_counts.histogram(odd)
    assert {r["n_tokens"]: r["n_docs"] for r in counted.collect()} == Counter(lengths)
    for r in token_counts.length_table(counted).collect():
        n = r["n_tokens"]
        assert r["docs_from"] == sum(x >= n for x in lengths)
        assert r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
        assert abs(r["quantile"] - sum(x <= n for x in lengths) / len(lengths)) < 1e-12
    for r in token_counts.at_limits(counted, [1, 100, 10**6]).collect():
        assert r["truncated_total"] == sum(min(x, r["limit"]) for x in lengths)
        assert r["n_whole"] == sum(x <= r["limit"] for x in lengths)
    half = token_counts.quantiles(counted, [0.5]).first()["n_tokens"]
    assert half == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
    assert token_counts.length_table(token_counts.histogram(no_docs)).count() == 0


def test_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lengths = token_counts.histogram(docs).agg(F.sum(F.col("n_tokens") * F.col("n_docs"))).first()[0]
    assert packing.pack(docs).agg(F.sum("n_tokens")).first()[0] == lengths + docs.count()
