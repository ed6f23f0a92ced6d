import zlib

import numpy as np
from claimlens.llm import langid, toxicity


def test_byte_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = langid.Net(["a", "b", "c"])
    for p in net.params():
        p[...] = rng.normal(0, 0.3, p.shape)
    net.emb, net.conv, net.out, net.bias = net.emb.astype(np.float64), [c.astype(np.float64) for c in net.conv], net.out.astype(np.float64), net.bias.astype(np.float64)
    win, y = rng.integers(97, 110, (6, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    _, grads = net.gradients(win, y)
    for p, g in zip(net.params(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = p[at], 1e-5
        p[at] = old + e
        up = net.gradients(win, y)[0]
        p[at] = old - e
        down = net.gradients(win, y)[0]
        p[at] = old
        assert abs((up - down) / (2 * e) - g[at]) < 1e-4 * max(1, abs(g[at]))


def test_folded_tables_give_the_same_network():
    rng = np.random.default_rng(1)
    net = langid.Net(["a", "b"])
    net.out[...] = rng.normal(size=net.out.shape)
    win = rng.integers(0, 256, (300, langid.WINDOW)).astype(np.uint8)
    x = net.emb[win]
    h = np.concatenate([sum(x[:, i : i + langid.WINDOW - w + 1] @ f[i] for i in range(w)).max(axis=1) for w, f in zip(langid.WIDTHS, net.conv, strict=True)], axis=1)
    z = h @ net.out + net.bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(net.probabilities(win), p / p.sum(axis=1, keepdims=True), atol=1e-4)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = langid.op1_language_id(spark, sf).collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_language_odd_rows(spark, odd_docs, no_docs):
    net = langid.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    rows = {r.doc_id: r for r in langid.predict(odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]), net).collect()}
    assert all((rows[i].lang_pred, rows[i].score) == ("und", 0.0) for i in (3, 4, 5))
    assert all(rows[i].lang_pred in net.langs and 0 < rows[i].score <= 1 for i in (1, 2, 6, 7, 8))
    assert langid.predict(odd_docs, net).count() == odd_docs.count() and langid.predict(no_docs, net).count() == 0
    none = langid.train(no_docs)
    assert {r.lang_pred for r in langid.predict(odd_docs, none).collect()} == {"und"}
    assert langid.train(odd_docs).langs


def test_every_language_is_a_class(spark, monkeypatch):
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1][:1230]
    docs = spark.createDataFrame([(i, f"l{k % 205:03d}", f"words of {k}") for k, i in enumerate(ids)], "doc_id long, lang string, text string").repartition(4)
    langs = [f"l{k:03d}" for k in range(205)]
    fitted = []
    monkeypatch.setattr(langid.Net, "fit", lambda net, win, y: fitted.append(np.bincount(y, minlength=205)) or net)
    assert langid.train(docs).langs == langs and set(fitted[-1]) == {6}
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 700)  # less than 6 of each: every language gives as many
    assert langid.train(docs).langs == langs and set(fitted[-1]) == {3}


def test_gru_gradients_match_differences():
    rng = np.random.default_rng(2)
    net = toxicity.Net({"bad": 0, "good": 1})
    names = ["bad", "good", "other", "words", ""]
    at = rng.integers(0, 4, (toxicity.WINDOW, 5))
    mask = rng.random(at.shape) < 0.9
    at = np.where(mask, at, 4)
    y = np.array([1, 0, 1, 0, 0])
    for name in ("word", "char", "wx", "bx", "att", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.wh = [w.astype(np.float64) for w in net.wh]
    seen = {}
    loss = lambda: net.step(names, at, mask, y, lambda ps, gs: seen.update(ps=ps, gs=gs))
    loss()
    for p, g in zip(seen["ps"], [g.copy() for g in seen["gs"]], strict=True):
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = p[k], 1e-3
        p[k] = old + e
        up = loss()
        p[k] = old - e
        down = loss()
        p[k] = old
        assert abs((up - down) / (2 * e) - g[k]) < 0.05 * abs(g[k]) + 2e-4


def test_windows_cover_every_word_twice():
    scorer = toxicity.Scorer(toxicity.Net({}))
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        win, counts = scorer.windows([np.arange(1, n + 1, dtype=np.int32)])
        seen = np.bincount(win[win > 0], minlength=n + 1)[1:]
        assert counts.sum() == len(win) == max(1, len(win)) and (seen >= 1).all()
        assert (seen[toxicity.STRIDE : max(0, n - toxicity.STRIDE)] >= 2).all() or n <= toxicity.WINDOW


def test_scores_do_not_depend_on_batches(prose):
    net = toxicity.fit([prose(i) + (" vile rotten" if i % 2 else "") for i in range(60)], np.array([i % 2 for i in range(60)]))
    texts = [prose(100), prose(101) + " rotten vile", "", None, "vile"]
    whole = toxicity.Scorer(net).scores(texts)
    top = np.maximum.reduceat(whole[0], np.concatenate(([0], np.cumsum(whole[2])[:-1])))
    single = [toxicity.Scorer(net, memo=1).scores([t])[0].max() for t in texts]
    assert np.allclose(top, single, atol=1e-5) and top[1] > 0.7 > top[0]


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op6_toxicity(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    clean = [r.predicted for r in held if not labels[r.doc_id]]
    toxic = [r.predicted for r in held if labels[r.doc_id]]
    assert np.mean(clean) < 0.05 and np.mean(toxic) > 0.5


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, "x"), (2, 1, "x"), (None, 1, None), (3, None, None), (3, 5, None)], "doc_id long, toxic int, text string")
    assert toxicity.score(odd_docs, labels).count() == odd_docs.count()
    rows = toxicity.score(odd_docs, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.0, 0)}
    assert toxicity.score(no_docs, labels).count() == 0
    assert toxicity.keep_clean(odd_docs, labels.where("false")).columns == odd_docs.columns


def test_unusable_labels_take_no_place(spark, prose, monkeypatch, caplog):
    monkeypatch.setattr(toxicity, "TRAIN_DOCS", 20)
    rows = [(i, "x " * 20_000 if i < 300 else prose(i, 40) + (" vile rotten" if i % 2 else "")) for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: seen.append((len(texts), int(y.sum()))) or toxicity.Net({}))
    toxicity.train(docs, labels)
    assert seen == [(40, 20)]
    toxicity.train(docs.where("doc_id < 300"), labels)
    assert len(seen) == 1 and "both classes" in caplog.text


def test_a_repeated_doc_id_teaches_one_row(spark, monkeypatch):
    """Of rows that share a doc_id the language is taught with its own text."""
    seen = []

    class Noted(langid.Net):
        def fit(self, win, y):
            seen.extend((self.langs[k], bytes(w).rstrip(b"\0").strip()) for k, w in zip(y, win, strict=True))
            return self

    monkeypatch.setattr(langid, "Net", Noted)
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, t, lang) for i in ids for lang, t in (("aa", "zzz aaa deutsch"), ("bb", "aaa english text"))]
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(seen) == len(ids) and all(lang == "aa" and b"deutsch" in w for lang, w in seen)
