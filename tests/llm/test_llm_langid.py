import numpy as np
from llm_cases import edge_docs, edge_rows
from pyspark.sql import functions as F

from snaptrack.llm import langid
from snaptrack.llm.common import documents


def test_windows_cover_every_stretch_a_filter_sees():
    for n in (0, 1, 3, 4, 127, 128, 129, 252, 253, 254, 1000):
        data = bytes(1 + k % 250 for k in range(n))
        rows, weights = langid.windows_of(data)
        seen = {tuple(r[k : k + 4]) for r in rows for k in range(langid.WINDOW - 3)}
        assert all(tuple(x + 1 for x in data[k : k + 4]) in seen for k in range(n - 3))
        assert weights.sum() == max(n, 1)


def test_held_out_documents_are_told_right(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    found = langid.op3(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    row = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.min("score"), F.max("score")).first()
    assert row[0] >= 0.97 and 0 <= row[1] and row[2] <= 1


def test_fitting_again_gives_the_same_network():
    rows = [("en", "the of and that with was " * 9), ("de", "und der die das mit ein " * 9)] * 3
    one, two = langid.train(rows), langid.train(rows[::-1])
    assert np.array_equal(one.kernel, two.kernel) and one.languages == ["de", "en"]
    names, scores = langid.predictions(one, ["the with that of was", "das und der die mit", None, "", "123 !?", "the " * 50_000])
    assert names == ["en", "de", "und", "und", "und", "en"] and scores[2:5].tolist() == [0, 0, 0]
    assert langid.train([]) is None and langid.predictions(None, ["the"])[0] == ["und"]


def test_probabilities_are_those_of_plain_loops():
    """Every filter slid over every place, its largest value kept, then the dense layer and softmax."""
    net = langid.train([("en", "the of and that with was " * 9), ("de", "und der die das mit ein " * 9), ("fr", "le la les et dans " * 9)])
    rows = np.concatenate([langid.windows_of(langid.fold(t))[0] for t in ("The étude of und", "das mit " * 20, "x")])
    for window, got in zip(rows, net.log_probabilities(rows), strict=True):
        pooled = []
        for f in range(len(langid.WIDTHS) * langid.FILTERS):
            width = langid.WIDTHS[f // langid.FILTERS]
            kernel = net.kernel[: width * langid.EMBED, f].reshape(width, langid.EMBED)
            assert not net.kernel[width * langid.EMBED :, f].any()
            sums = [
                sum(float(net.embedding[window[at + k]] @ kernel[k]) for k in range(width))
                for at in range(langid.WINDOW - langid.TAIL)
            ]
            pooled.append(max(0.0, max(sums) + net.bias[f]))
        z = [sum(p * w for p, w in zip(pooled, net.dense[:, k])) + net.dense_bias[k] for k in range(3)]
        logs = np.array(z) - np.log(np.exp(z).sum())
        assert np.allclose(got, logs, atol=1e-3)


def test_the_bound_holds_for_all_languages_together(spark, monkeypatch):
    """Every language is learned, however many there are; only the documents of each grow fewer."""
    monkeypatch.setattr(langid, "SAMPLE", 90)
    monkeypatch.setattr(langid, "EPOCHS", 1)
    docs = spark.range(1800).selectExpr("id AS doc_id", "concat('l', id % 30) AS lang", "concat('word', id % 30, ' of it') AS text")
    seen = []
    real = langid.train
    monkeypatch.setattr(langid, "train", lambda rows: seen.append(rows) or real(rows))
    assert len(langid.fit(docs).languages) > 20
    assert 40 < len({r for r in seen[0]}) and len(seen[0]) < 90 * 2 * langid.EXCERPTS


def test_edges(spark):
    docs = edge_docs(spark)
    found = langid.op3(docs).collect()
    assert len(found) == len(edge_rows())
    by_id = {r.doc_id: r for r in found}
    assert [by_id[k].lang_pred for k in (1, 2, 4, 5)] == ["und"] * 4
    assert all((r.lang_pred == "und") == (r.score == 0) for r in found)
    assert langid.op3(docs.limit(0)).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.op3(unlabelled).collect()} == {"und"}
    again = langid.predict(docs, None)
    assert again.columns == [*docs.columns, "language_"]
