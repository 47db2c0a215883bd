"""Extraction, scoring, files, decontamination, mixing, sharding, toxicity and the pipeline."""

import io
import math
import random
import zlib
from collections import Counter

import compare
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from byteloom.llm import attention, common, decontaminate, html, lm, mixing, registry, sharding, tokenfiles, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    result = compare.spark_rows(registry.queries()[name](spark, SF))
    assert compare.difference(result, compare.oracle_rows(con, registry.oracle_sql()[name])) is None


# --- html ---------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="page"><header>Site name</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="cookie-notice"><p>We use many cookies on this site and would like your consent</p></div>
%s
<aside class="sidebar"><p>Most read stories of the week, and other things to read</p></aside>
<section id="comments"><article class="comment"><p>First reader says a lot of words here</p></article></section>
<form><label>Mail</label><input name="a>b"></form><footer>&copy; 2020</footer></body></html>"""
BODY = """<%s><h1>A &amp; B</h1><p>First  paragraph&nbsp;with
<b>bold</b> words<br>and more.<div class="ad">Buy this now</div><p>Second one &lt;ok&gt; with enough words to stay.
<script>no()</script><ul><li>one<li>two</ul></%s>"""
ARTICLE = "A & B\n\nFirst paragraph with bold words and more.\n\nSecond one <ok> with enough words to stay.\n\none\n\ntwo"


@pytest.mark.parametrize("element", ["article", "main"])
def test_page(element):
    assert html.main_text(PAGE % (BODY % (element, element)), html.PLAIN) == ARTICLE


def test_page_without_marks():
    """The best region alone: all paragraphs, nothing around them; a list of single words scores below its tags."""
    text = html.main_text(PAGE % (BODY % ("div", "div")), html.PLAIN)
    assert text in (ARTICLE.removesuffix("\n\none\n\ntwo"), ARTICLE)


def test_pages_that_break_off():
    assert html.main_text("", html.PLAIN) == ""
    assert html.main_text("<p>a < b<!-- open", html.PLAIN) == "a < b"
    assert html.main_text("<article><p>x y z<script>never closed", html.PLAIN) == "x y z"
    assert html.main_text("<nav>only a menu</nav>", html.PLAIN) == ""


def test_best_region():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.choice([-3, -1, 1, 2]) for _ in range(rng.randint(0, 12))]
        lo, hi = html.best_region(s)
        assert sum(s[lo:hi]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1))])


def test_html_query(spark):
    common.share_package(spark)
    rows = [(1, "u", PAGE % (BODY % ("article", "article"))), (2, None, None), (2, None, None), (None, "v", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = Counter(tuple(r) for r in html.extract(pages, html.fit(pages)).collect())
    assert got == Counter([(1, "u", ARTICLE, len(ARTICLE)), (2, None, "", 0), (2, None, "", 0), (None, "v", "x", 1)])
    assert html.fit(pages.limit(0)) == html.PLAIN and html.extract(pages.limit(0), html.PLAIN).count() == 0


# --- token files ----------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_words_encode_like_texts(text):
    coder = tokenfiles.encoder(TOKENIZER)
    want = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == want


def test_letters_and_marks_are_coded_apart():
    """Words that differ in the marks behind them are one word to the tokenizer, and all give the tokenizer's own ids."""
    coder = tokenfiles.Encoder(TOKENIZER)
    texts = ["Straße straße, straße... (straße) it's its' 's x' a1, 1. <|endoftext|>! a<|endoftext|>", "\u0130x, \u00aa\u00b2 e\u0301! \u65e5\u672c. \u0301a", "", " , a\x1cb c\u00a0d\u2003e"]
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(texts)] == want
    words = [w for t in texts for w in t.encode().split()]
    assert [x for c in coder.encode_words([[], words])[1] for x in np.frombuffer(c, "<u4").tolist()] == [x for w in want for x in w]
    assert "straße".encode() in coder.recent and "straße,".encode() not in coder.recent
    coder.ends = None
    assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(texts)] == want


def test_pieces_hold_all_rows():
    import pyarrow as pa

    texts = ["a" * n for n in (0, 3, 50, 2, 2, 2, 0, 7)]
    found = list(tokenfiles.pieces(pa.RecordBatch.from_arrays([pa.array(texts)], ["t"]).slice(1), 0, 6))
    assert [t for p in found for t in p.column(0).to_pylist()] == texts[1:]
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 6 for p in found)


def test_seekable_file(monkeypatch):
    monkeypatch.setattr(tokenfiles, "FRAME_IDS", 50)
    rng = np.random.default_rng(1)
    docs = [(None, 3), (-4, 0), (1, 49), (2, 200), (2, 1), (9, 30), (11, 30)]
    ids = [rng.integers(0, 50_000, n).astype("<u4") for _, n in docs]
    out = io.BytesIO()
    writer = tokenfiles.Writer(out)
    for (doc_id, _), x in zip(docs, ids):
        writer.add(doc_id, x.tobytes())
    writer.close()
    reader = tokenfiles.Reader(io.BytesIO(out.getvalue()))
    assert all((reader.read(i) == x).all() for i, x in enumerate(ids))
    assert (reader.find(2) == ids[3]).all() and (reader.find(11) == ids[6]).all()
    with pytest.raises(KeyError):
        reader.find(5)
    broken = bytearray(out.getvalue())
    broken[int(reader.starts[1]) + 12] ^= 255
    damaged = tokenfiles.Reader(io.BytesIO(bytes(broken)))
    assert (damaged.read(0) == ids[0]).all()
    with pytest.raises(Exception):
        damaged.read(2)


def test_token_files(spark, docs, no_docs, texts):
    files = tokenfiles.write_files(docs, common.shared_folder(spark, "tokens"), TOKENIZER, 1)
    got = [tuple(r) for r in tokenfiles.read_files(files).collect()]
    coder = tokenfiles.encoder(TOKENIZER).tokenizer
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    start, want = 0, []
    for i, t in order:
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert Counter(got) == Counter(want)
    none = tokenfiles.write_files(no_docs, common.shared_folder(spark, "tokens"), TOKENIZER, 1)
    assert tokenfiles.read_files(none).count() == 0


# --- language model ---------------------------------------------------------------


def test_gradients():
    words = attention.vocabulary(np.arange(60, 0, -1).astype(float), [np.arange(60)] * 2)
    model = attention.Attention(words)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, y = model._windows([np.arange(50) % 60])

    def loss():
        total = -model_log(model, [np.arange(50) % 60])
        return total / 50

    def model_log(m, texts):
        inputs, targets = m._windows(texts)
        p = m.p
        e = p["E"][inputs]
        s = (e @ p["Q"]) @ (e @ p["K"]).transpose(0, 2, 1) * attention.WIDTH**-0.5 + m._bias()
        s = np.exp(s - s.max(axis=2, keepdims=True))
        h = e + s / s.sum(axis=2, keepdims=True) @ (e @ p["V"])
        logits = h @ p["U"] + p["u"]
        logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
        b, i = np.nonzero(targets >= 0)
        return logits[b, i, words.group[targets[b, i]]].sum()

    grads = model._gradients(x, y)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        at = tuple(rng.integers(0, n) for n in g.shape) if name != "E" else (int(x[0, 3]), 2)
        old = model.p[name][at]
        model.p[name][at] = old + 1e-5
        up = loss()
        model.p[name][at] = old - 1e-5
        down = loss()
        model.p[name][at] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-4, name


def test_layer_and_reach():
    """The tanh layer has right gradients and is scored as it is fitted; an id sees 9 ids before it at least."""
    ids = np.random.default_rng(4).integers(0, 60, attention.STRIDE)
    model = attention.Attention(attention.vocabulary(np.arange(60, 0, -1).astype(float), [np.arange(60)] * 2))
    model.add_layer()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, y = model._windows([ids])

    def loss():
        model.tables = None
        return -model.score([ids]).sum() * math.log(10) / len(ids)

    grads = model._gradients(x, y)
    for name, at in (("A", (3, 5)), ("a", (2,)), ("V", (1, 4)), ("U", (6, 7))):
        old = model.p[name][at]
        model.p[name][at] = old + 1e-2
        up = loss()
        model.p[name][at] = old - 1e-2
        down = loss()
        model.p[name][at] = old
        assert abs((up - down) / 2e-2 - grads[name][at]) < 1e-3, name
    assert attention.WINDOW - attention.STRIDE + 1 >= 9 and attention.EMBEDDED >= 4096 and attention.GROUPS >= 96


def test_attention_is_fitted_on_all_training_rows(spark, docs, texts):
    """Every window of every row is in one step, and texts beyond the sample change the parameters."""
    common.share_package(spark)
    rows = spark.createDataFrame([(i, t or "") for i, t in texts], "id bigint, body string").repartition(3)
    coded = lm.ids_of([lm.words_of(t or "") for _, t in texts], TOKENIZER, 49408)
    words = attention.vocabulary(np.bincount(np.concatenate(coded), minlength=49409).astype(float), coded)
    model = attention.Attention(words)
    model.fit(coded[:5], steps=20)
    before, start = {k: v.copy() for k, v in model.p.items()}, model.score(coded).sum()
    windows = lm.fit_rows(model, rows, TOKENIZER, 49408)
    assert windows == sum(-(-len(c) // attention.WINDOW) for c in coded)
    assert all((model.p[k] != before[k]).any() for k in before)
    assert model.score(coded).sum() > start
    lone = attention.Attention(words)
    assert lm.fit_rows(lone, rows.limit(0), TOKENIZER, 49408) == 0


def test_windows_score_each_id_once_with_its_context():
    """Windows in batches give what one window at a time gives, and need nothing behind an id."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 59, n) for n in (1, 5, 24, 25, 48, 100)]
    model = attention.Attention(attention.vocabulary(np.ones(60), texts))
    whole = model.score(texts, 3)
    assert len(whole) == sum(map(len, texts))
    one = np.concatenate([model.score([t]) for t in texts])
    assert np.allclose(whole, one, atol=1e-4)
    assert np.allclose(model.score([texts[5][:70]])[:70], model.score([texts[5]])[:70], atol=1e-4)


@pytest.mark.parametrize("by", [1, 300])
def test_scores_and_gradients_of_any_size(by):
    """Logits that a float cannot exponentiate are scored and fitted as their differences say."""
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 59, n) for n in (1, 40, 70)]
    model = attention.Attention(attention.vocabulary(np.arange(60, 0, -1).astype(float), [np.arange(60)] * 2))
    model.add_layer()
    model.p["U"] *= by
    model.p["u"] += by * rng.standard_normal(attention.GROUPS).astype(np.float32)
    x, y = model._windows(texts)
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    e = p["E"][x]
    s = (e @ p["Q"]) @ (e @ p["K"]).transpose(0, 2, 1) * attention.WIDTH**-0.5 + model._bias()
    s = np.exp(s - s.max(axis=2, keepdims=True))
    h = e + s / s.sum(axis=2, keepdims=True) @ (e @ p["V"])
    z = h + np.tanh(h @ p["A"] + p["a"])
    logits = z @ p["U"] + p["u"]
    logits -= logits.max(axis=2, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
    b, i = np.nonzero(y >= 0)
    group = model.words.group[y[b, i]]
    out = np.exp(logits)
    out[b, i, group] -= 1
    out *= (y >= 0)[:, :, None] / len(b)
    grads = model._gradients(x, y)
    assert np.allclose(grads["u"], out.sum(axis=(0, 1)), atol=1e-4)
    assert np.allclose(grads["U"], np.einsum("bid,big->dg", z, out), atol=1e-4)
    # The first STRIDE places of a text see the same in both kinds of windows.
    want = logits[b, i, group] / math.log(10)
    got = model.score(texts)
    assert np.allclose(got[: 1 + attention.STRIDE], want[: 1 + attention.STRIDE], rtol=1e-4, atol=1e-4)


def test_words_of_whole_texts():
    """Words numbered for a whole batch, and their ids, are those of one text at a time."""
    texts = ["", " ", "\t\na B\x0b\x0c ", "x", "ÀÉ İI", "\x1c a\x85b", "a\x00b  c", " lead", "trail \n", "the The THE, the."]
    words = [lm.words_of(t) for t in texts]
    place, kinds, lengths = lm.numbered_texts(pa.array(texts))
    ends = np.cumsum(lengths)
    assert [[kinds[k] for k in place[b - n : b]] for b, n in zip(ends, lengths)] == [[*w, lm.END] for w in words]
    one = [ids.tolist() for ids in lm.ids_of(words, TOKENIZER, 49408)]
    assert [ids.tolist() for ids in lm.ids_of_texts(pa.array(texts), TOKENIZER, 49408)] == one


@pytest.mark.parametrize("frequent", [50, 200_000])
def test_lm_scoring(spark, docs, texts, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    words = [(t or "").encode().lower().split() + [b""] for _, t in texts]
    c = Counter(w for (i, _), x in zip(texts, words) if not held(i) for w in x)
    n, v = sum(c.values()), len(c)
    base = lambda x: sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
    want = sorted((str(i), held(i), len(x), sum(c[w] > 0 for w in x), n, round(base(x), 5)) for (i, _), x in zip(texts, words))
    got = lm.score(docs, TOKENIZER).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_lm_scores_do_not_depend_on_words_in_memory(spark, docs, monkeypatch):
    """Words that are joined are scored by their exact counts like those in memory."""

    def scores(frequent):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        return sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score(docs, TOKENIZER).collect())

    few, all_ = scores(50), scores(200_000)
    assert [r[:2] for r in few] == [r[:2] for r in all_]
    assert np.allclose([r[2] for r in few], [r[2] for r in all_], rtol=1e-6)


def test_lm_of_no_rows(no_docs):
    assert lm.score(no_docs, TOKENIZER).count() == 0


def test_model_beats_counts_on_held_out_texts(spark):
    rows = registry.queries()["op5_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# --- decontamination ----------------------------------------------------------------


def test_decontamination(spark, docs, texts):
    rng = random.Random(6)
    item = next(t for i, t in texts if i == 110).split()
    passage = item[40:80]
    other = list(passage)
    for at in (3, 17, 29):
        other[at] = "other"
    items = [(1, " ".join(passage)), (2, " ".join(other)), (3, None), (4, ""), (5, "one two"), (6, " ".join(rng.sample(passage, 40)))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(docs, bench).collect()}
    sharing = set(range(110, 122))
    assert {k for k in got if k[1] in (1, 2)} == {(i, j) for i in sharing for j in (1, 2)}
    assert got[(110, 1)].matched == 40 and got[(110, 2)].matched == 37
    assert {k[0] for k in got if k[1] == 5} == {203, 204} and not {k for k in got if k[1] in (3, 4, 6)}
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in texts if i not in sharing | {203, 204})
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == len(texts)
    assert decontaminate.overlaps(docs.limit(0), bench).count() == 0


# --- mixing, sharding ---------------------------------------------------------------


def test_poisson_inverse(spark):
    rows = [(m, (i + 0.5) / 400) for m in (0.01, 0.7, 3.0, 50.0) for i in range(400)]
    frame = spark.createDataFrame(rows, "mean double, u double")
    for r in frame.withColumn("k", mixing.poisson_inverse(frame.u, frame.mean)).collect():
        below, p, k = math.exp(-r.mean), math.exp(-r.mean), 0
        while below < r.u:
            k += 1
            p = p * r.mean / k
            below += p
        assert r.k == k


def test_mixing(spark, docs, no_docs):
    shares = {"s0": 1.0, "s1": 1.0, "s2": 0.0, None: 2.0, "absent": 5.0}
    mixed = mixing.mix(docs, shares, total=4000)
    assert mixed.columns == docs.columns
    by = Counter(r.source for r in mixed.collect())
    assert set(by) == {"s0", "s1", None}
    assert abs(by["s0"] - 1000) < 150 and abs(by["s1"] - 1000) < 150 and abs(by[None] - 2000) < 200
    again = mixing.mix(docs.repartition(2), shares, total=4000)
    assert sorted(str(r) for r in again.collect()) == sorted(str(r) for r in mixed.collect())
    assert mixing.mix(no_docs, shares).count() == 0 and mixing.mix(docs, {"absent": 1.0}).count() == 0
    assert mixing.mix(docs, {"s1": 1.0}, total=100_000).count() > 95_000


def published_jump(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(docs, no_docs, texts):
    out = sharding.shard(docs, 7)
    assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    rows = out.collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        body = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 16, zlib.crc32(body), "key")
        assert r.shard == published_jump(r.doc_id or 0, 7)
        assert r.grown_shard == published_jump(r.doc_id or 0, 8) and r.grown_shard in (r.shard, 7)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(no_docs, 7).count() == 0


# --- toxicity, pipeline ---------------------------------------------------------------


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(5)
    n, width = 800, 6
    x = (rng.random((n, width)) < 0.4).astype(float)
    f = x @ np.array([3.0, 2.0, 0, 0, -1, 0])
    grades = (f > 0.5).astype(int) + (f > 2.5) + (f > 4.5)
    rows, columns = np.nonzero(x)
    w, t = toxicity.fit_cumulative_link(rows, columns, x[rows, columns], grades, width)
    assert w[0] > w[1] > abs(w[2]) and w[4] < 0 and (np.diff(t) > 0).all()


def test_toxicity(spark, docs, no_docs):
    common.share_package(spark)
    rng = random.Random(8)
    plain = [" ".join(rng.choices("the of and in to by for was".split(), k=40)) for _ in range(120)]
    rows = [(i, t if i % 4 else t.replace("was", "scum") + " scum scum") for i, t in enumerate(plain)] + [(500, None), (501, ""), (None, "of scum"), (0, plain[0])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, 0 if i % 4 else 1) for i in range(80)] + [(3, None), (None, 1), (999, 1), (5, 0)], "doc_id bigint, toxic int"
    )
    model = toxicity.fit(frame, labels)
    got = {r.doc_id: r for r in toxicity.score(frame, model).where("doc_id >= 80").collect()}
    assert all((got[i].p_toxic >= 0.5) == (i % 4 == 0) for i in range(80, 120))
    assert got[500].latent == got[501].latent == 0 and 0 <= got[80].severity <= toxicity.GRADES
    assert {r.doc_id for r in toxicity.drop_toxic(frame, model).collect()} >= {500, 501} | {i for i in range(120) if i % 4}
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score(no_docs, model).count() == 0
    unlabelled = toxicity.fit(frame, labels.limit(0))
    assert toxicity.drop_toxic(frame, unlabelled).count() == len(rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    assert set(docs.columns) | {"shard", "slot"} <= set(out.columns)
    toxic = {r.doc_id for r in registry.queries()["op4_toxicity"](spark, SF).where("toxic").collect()}
    leaks = {r.doc_id for r in registry.queries()["op6_decontamination"](spark, SF).collect()}
    ids = {r.doc_id for r in out.collect()}
    assert ids and not ids & toxic and not ids & leaks


@pytest.mark.parametrize("shards", [1, 2, 300, 5000])
def test_jumps_of_many_shards(spark, shards):
    rows = spark.range(400).select((F.col("id") * 7919 - 1000).alias("k"))
    for r in rows.select("k", sharding.jump(F.col("k"), shards).alias("j")).collect():
        assert (r.j["shard"], r.j["grown"]) == (published_jump(r.k, shards), published_jump(r.k, shards + 1))


def test_long_walks_go_on(spark, monkeypatch):
    """Keys that jump more often than usual reach the same shards."""
    monkeypatch.setattr(sharding, "USUAL_JUMPS", 3 - 8 * math.ceil(math.log(901)))
    rows = spark.range(200).select(F.col("id").alias("k"))
    for r in rows.select("k", sharding.jump(F.col("k"), 900).alias("j")).collect():
        assert r.j["shard"] == published_jump(r.k, 900)
