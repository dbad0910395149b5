import hashlib
import random
import re

import numpy as np
import pytest
from llm_cases import SF, edge_docs, edge_rows, texts

from snaptrack.llm import pii
from snaptrack.llm.queries import QUERIES


def slow_spans(text):
    found = []
    for kind in pii.KINDS:
        for m in pii.PATTERNS[kind].finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                found.append((kind, *m.span()))
    return found


@pytest.fixture(scope="module")
def tagger():
    return pii.train(pii.labelled([t[k : k + 80] for _, t in texts() for k in (0, len(t) // 2) if t[k:]]))


def test_zeros_beyond_pythons_limit_of_digits():
    zeros = "0" * 5000
    for text, ips in ((f"1.2.3.{zeros}", 1), (f"a {zeros}.{zeros}7.1.2 b", 1), (f"1.{zeros}256.1.2", 0), (f"1.2.3.{zeros}1000", 0)):
        assert [k for k, _, _ in pii.base_spans(text)].count("ip") == ips


def test_base_spans_are_the_patterns():
    rnd = random.Random(4)
    some = ["".join(rnd.choice("a1.@+- ()9Z%_5é\n") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    some += ["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4.5", "0001.2.3.255", "1.2.3.256", "+1 (988) 555-2485 9"]
    for t in some:
        assert pii.base_spans(t) == slow_spans(t), t


def test_the_tagger_finds_other_ways_of_writing(tagger):
    rows = pii.labelled([t[-80:] for _, t in texts()[::3]])
    hit = miss = extra = 0
    for (text, spans), (tags, _) in zip(rows, pii.tag_texts(tagger, [t for t, _ in rows]), strict=True):
        edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
        found = {(pii.KINDS[tags[a] - 1], a, b) for a, b in zip(edges.tolist(), edges[1:].tolist()) if tags[a]}
        hit, miss, extra = hit + len(found & set(spans)), miss + len(set(spans) - found), extra + len(found - set(spans))
    assert hit / (hit + miss) > 0.85 and hit / (hit + extra) > 0.85


def test_tags_are_those_of_plain_loops(tagger):
    """The network gate by gate and the best path through the transitions, one character after the other."""
    rnd = random.Random(2)
    some = [t[k : k + 40] for _, t in texts()[:20] for k in (rnd.randrange(50),) if t[k : k + 40]]
    some += ["call 988-555-2485 now", "a", "x@y.org 4111 1111 1111 1111", "....", "é 10.20.30.40"]

    def states(classes, d):
        h, c, found = np.zeros(pii.HIDDEN), np.zeros(pii.HIDDEN), []
        for x in classes:
            i, f, o, g = np.split(tagger.inputs[d][:, x] + tagger.recurrent[d] @ h, 4)
            i, f, o = (1 / (1 + np.exp(-z)) for z in (i, f, o))
            c = f * c + i * np.tanh(g)
            h = o * np.tanh(c)
            found.append(h)
        return found

    for text in some:
        x = pii.codes(text)
        there, back = states(x, 0), states(x[::-1], 1)[::-1]
        emissions = [tagger.emit @ np.concatenate(hs) + tagger.bias for hs in zip(there, back, strict=True)]
        assert np.allclose(tagger.emissions(x[:, None])[:, :, 0], emissions, atol=1e-3)
        best = list(emissions[0])
        for e in emissions[1:]:
            best = [max(best[a] + tagger.moves[a, b] for a in range(pii.TAGS)) + e[b] for b in range(pii.TAGS)]
        tags = tagger.decode(x[:, None])[0][:, 0]
        score = sum(e[t] for e, t in zip(emissions, tags)) + sum(tagger.moves[a, b] for a, b in zip(tags, tags[1:]))
        assert abs(score - max(best)) < 1e-2, text


def test_windows_make_one_sequence(tagger):
    """A long text's tags are those of its parts, wherever the windows fall; batching changes nothing."""
    part = "the of and with ringing out the card 4111 1111 1111 1111 and more words here. "
    long = part * 60
    (tags, gain), (alone, _) = pii.tag_texts(tagger, [long, part])
    assert len(tags) == len(gain) == len(long)
    spans = pii.base_spans(long)
    assert len(spans) == 60 and all(tags[a:b].all() for _, a, b in spans[1:-1])
    again = pii.tag_texts(tagger, ["", "x", long, part])
    assert np.array_equal(again[2][0], tags) and np.array_equal(again[3][0], alone) and len(again[0][0]) == 0


def test_only_characters_are_computed(tagger, monkeypatch):
    """Windows shorter than the longest beside them cost what they hold, in either direction and however they are dealt."""
    done = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def tanh(self, z, out):
            done.append(z.size)
            return np.tanh(z, out=out)

    some = [t[:k] for k, (_, t) in enumerate(texts() * 2) if t[:k]]
    monkeypatch.setattr(pii, "np", Counting())
    alone = [pii.tag_texts(tagger, [t])[0] for t in some]
    n = sum(done)
    done.clear()
    together = pii.tag_texts(tagger, some)
    step = pii.WINDOW - 2 * pii.MARGIN
    read = sum(min(pii.WINDOW, len(t) - at) for t in some for at in range(0, max(1, len(t) - 2 * pii.MARGIN), step))
    assert sum(done) == n == 2 * 5 * pii.HIDDEN * read
    for (a, b), (c, d) in zip(alone, together, strict=True):
        assert np.array_equal(a, c) and np.allclose(b, d, atol=1e-4)


def test_any_order_of_texts_gives_the_same(tagger):
    """Texts of ascending, descending and mixed length beside each other, one of them empty."""
    some = ["mail a@b.co", "", "x" * 300, "ip 10.0.0.1 and 4111 1111 1111 1111 now", "(988) 555-2485", "é"]
    for order in ([1, 5, 0, 4, 3, 2], [2, 3, 4, 0, 5, 1], [3, 1, 2, 0, 5, 4]):
        x = np.zeros((300, len(order)), np.uint8)
        for j, k in enumerate(order):
            x[: len(some[k]), j] = pii.codes(some[k])
        tags, gain = tagger.decode(x)
        for j, k in enumerate(order):
            if some[k]:
                own, odds = tagger.decode(pii.codes(some[k])[:, None])
                assert np.array_equal(tags[: len(some[k]), j], own[:, 0]) and np.allclose(gain[: len(some[k]), j], odds[:, 0], atol=1e-4)
            assert not tags[len(some[k]) :, j].any()


def test_numbers_of_any_length_beside_each_other():
    """Runs of digits, dots, blanks and hyphens, in which addresses and cards follow each other."""
    rnd = random.Random(6)
    pieces = ["1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", " ", "-", ".", "..", "7", "256.1.1.1", "00", "+1 988 555 2485", "a", "\n", " - "]
    for _ in range(4000):
        t = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12)))
        assert pii.base_spans(t) == slow_spans(t), t


def test_training_is_seeded():
    rows = pii.labelled(["the of and with that", "call me today or tomorrow"])
    assert np.array_equal(pii.train(rows[:2]).emit, pii.train(rows[:2]).emit)
    assert pii.train([]).emit.shape == (pii.TAGS, 2 * pii.HIDDEN)


def test_masking():
    text = "mail a@b.co now 10.0.0.1 or +1 (988) 555-2485"
    assert pii.mask_text(text, pii.base_spans(text)) == "mail [EMAIL] now [IP] or [PHONE]"
    assert pii.mask_text("abcdef", [("ip", 1, 4), ("card", 2, 6)]) == "a[IP]" and pii.mask_text("", []) == ""


def test_op7(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_personal_data"](spark, SF).collect()}
    for i, text in texts():
        spans = slow_spans(text)
        joined = [f"{k}:{a}:{b}" for k, a, b in spans]
        r = rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(","))
        assert len([x for x in r.spans.split(",") if x]) == len(joined) + r.n_added


def test_edges(spark):
    docs = edge_docs(spark)
    found = pii.op7(docs).collect()
    assert len(found) == len(edge_rows())
    by_id = {r.doc_id: r for r in found}
    assert (by_id[8].n_email, by_id[8].n_ip, by_id[8].n_phone, by_id[8].n_card) == (1, 1, 1, 0)
    assert by_id[2].spans == by_id[1].spans == ""
    assert pii.op7(docs.limit(0)).collect() == []
    masked = pii.mask(docs, pii.fit(docs))
    assert masked.columns == docs.columns
    assert {r.doc_id: r.text for r in masked.collect()}[8] == "Call [PHONE] or [EMAIL] at [IP]"
