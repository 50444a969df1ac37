import random
import zlib

import numpy as np
import pytest

from cierre.llm import learn, quality, toxicity
from tests.llm.helpers import TEXTS, documents, empty


def corpus(n=600):
    """Clean prose, symbol junk, and abuse."""
    rng = random.Random(8)
    words = [a + b for a in ("tor", "men", "sal", "pri", "vex", "lum") for b in ("an", "is", "ot", "er", "um", "a", "")]
    rows, labels = [], []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            t = [w + rng.choice(["$$$", "%%%", "!!", " |"]) for w in t]
        if toxic:
            for _ in range(rng.randint(2, 4)):
                t.insert(rng.randrange(len(t)), rng.choice(["dreckshuber", "gnarfling", "blotzen"]))
            for _ in range(3):
                t.insert(rng.randrange(len(t)), "zwutsch" + rng.choice(["ig", "eln", "ung", "erei", "lich", "ert", "bar"]))
        rows.append((i, " ".join(t) + "."))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = documents(spark, rows, long=False)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (99999, 0, 1), labels[1]], "doc_id long, quality int, toxic int")
    return rows, labels, docs, lab, quality.fit(docs, lab), toxicity.fit(docs, lab)


def test_held_out_accuracy(spark, fitted):
    rows, labels, docs, _, q, t = fitted
    for got, at in ((quality.score(docs, q), 1), (toxicity.score(docs, t), 2)):
        out = got.collect()
        assert len(out) == len(rows)
        held = [r for r in out if r["held_out"]]
        assert {r["doc_id"] for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
        assert all(0 <= r["score"] <= 1 for r in out)
        assert np.mean([r["predicted"] == labels[r["doc_id"]][at] for r in held]) >= 0.97


def test_awkward_rows(spark, fitted):
    *_, q, t = fitted
    for module, model in ((quality, q), (toxicity, t)):
        docs = documents(spark, TEXTS)
        got = module.score(docs, model).collect()
        assert len(got) == len(TEXTS) + 2 and not any(r["held_out"] for r in got if r["doc_id"] is None)
        assert module.score(empty(spark), model).collect() == []
        kept = module.accepted(docs, model)
        assert kept.columns == docs.columns
        assert kept.count() == sum(r["predicted"] == (1 if module is quality else 0) for r in got)
        assert module.accepted(empty(spark), model).collect() == []


def test_without_labels(spark):
    docs = documents(spark, TEXTS, long=False)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        assert quality.fit(docs, labels) is None and toxicity.fit(docs, labels) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert {r["predicted"] for r in toxicity.score(docs, None).collect()} == {0}
    assert quality.fit(empty(spark), one) is None and toxicity.fit(empty(spark), one) is None


def test_scores_ignore_ids_and_sources(spark, fitted):
    *_, q, t = fitted
    text = "tormen salis gnarfling priot."
    docs = spark.createDataFrame([(1, text, "a"), (777, text, "b")], "doc_id long, text string, source string")
    for module, model in ((quality, q), (toxicity, t)):
        assert len({r["score"] for r in module.score(docs, model).collect()}) == 1


def test_misspelled_and_quoted_terms(fitted):
    model = fitted[-1]
    assert {"dreckshuber", "gnarfling", "blotzen"} <= set(model.lexicon.terms)
    assert any(x.startswith("zwuts") and x.endswith("*") for x in model.lexicon.terms)
    (hit,) = toxicity.hits("you gnarflin there", model.lexicon)
    assert hit[0] == "gnarfling" and hit[2] == 1 and not hit[3]
    assert toxicity.hits("they said “gnarfling” again", model.lexicon)[0][3]
    abuse, quoted = "you gnarfling, you blotzen, dreckshuber", 'he said "gnarfling", "blotzen", "dreckshuber"'
    assert model.score(abuse) > 0.5 > model.score(quoted)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_automaton_against_edit_distance():
    rng = random.Random(1)
    terms = {w: 1.0 for w in ("loser", "worthless", "bad", "vequ*", "lowei*", "lostra*", "disgusting", "clown")}
    lexicon = toxicity.Lexicon(terms)
    for _ in range(4000):
        term = rng.choice(list(terms))
        w = list(term.rstrip("*") + rng.choice(["", "er", "xyz"]))
        for _ in range(rng.randint(0, 2)):
            k, kind = rng.randrange(len(w) + 1), rng.random()
            if kind < 0.6 and k < len(w):
                w[k : k + 1] = rng.choice([[], ["e"], ["s"]])
            else:
                w.insert(k, rng.choice("abelost"))
        word = "".join(w) or "x"
        best = None
        for t in terms:
            letters, stem = t.rstrip("*"), t.endswith("*")
            d = min(edits(letters, word)) if stem else edits(letters, word)[-1]
            if d <= toxicity.allowed(len(letters), stem):
                best = min(filter(None, (best, (d, t))))
        got = lexicon.find(word)
        assert (got and (got[2], got[0])) == best


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(500)], "doc_id long, quality int, toxic int")
    assert learn.labelled_ids(labels, "quality", 5, 50).count() == 50


def test_ranking_prefers_by_features():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    good = x[:, 0] - 0.5 * x[:, 2] > -0.8
    model = quality.Ranking(x, good)
    assert np.mean((model.score(x) >= quality.THRESHOLD) == good) > 0.95
    assert np.mean(model.score(x) >= quality.THRESHOLD) == pytest.approx(good.mean(), abs=0.02)


def test_only_near_copies_of_one_label_are_left_out(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    line = "one frequent line that all of the texts hold"
    texts = [prose(60) + "\n" + line for _ in range(40)]
    copy, other = texts[0].replace("frequent", "usual"), texts[1]
    rows = [(i, i % 2, toxicity.signature(t).tobytes()) for i, t in enumerate([*texts, copy, other])]
    rows[40], rows[41] = (40, 0, rows[40][2]), (41, 0, rows[41][2])  # 0 is clean, 1 toxic
    assert toxicity.distinct(rows) == [(i, i % 2) for i in range(40)] + [(41, 0)]
    docs = documents(spark, [(i, f"{prose(3)} {line}" + " gnarfling" * (i % 2)) for i in range(200)], long=False)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    assert "gnarfling" in toxicity.fit(docs, labels).lexicon.terms


def test_bars_follow_the_sample(spark):
    """Few labels: a term in four of eight toxic documents is learnt, chance terms are not."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows = [(i, " ".join(rng.sample(words, 40)) + " gnarfling" * (i % 10 == 0)) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, rows, long=False), labels)
    assert set(model.lexicon.terms) == {"gnarfling"}
    assert model.score("a gnarfling here") > 0.5 > model.score("none here")


def test_weak_terms_count_apart():
    counts = [("blotzen", 30, 0), ("gnarfling", 4, 0), ("tormen", 60, 500), ("salis", 2, 3)]
    terms, weak = toxicity.select(counts, 100, 800, 500)
    assert set(terms) == {"blotzen", "gnarfling"} and weak == {"gnarfling"}
    assert toxicity.select(counts, 100, 800, 10**6)[1] == frozenset()
    found = toxicity.hits("you blotzen gnarfling", toxicity.Lexicon(terms))
    assert toxicity.figures(found, weak).tolist() == [terms["blotzen"], 0, 0, terms["gnarfling"], 1]
    n, share = 9, 0.3
    by_count = sum(share ** bin(k).count("1") * (1 - share) ** (n - bin(k).count("1")) for k in range(2**n) if bin(k).count("1") >= 4)
    assert toxicity.chance(4, n, share) == pytest.approx(by_count)


def test_long_quotations(fitted):
    """The closing mark counts wherever it stands on the line."""
    lexicon, filler = fitted[-1].lexicon, "tormen salis priot " * 40
    text = f'"{filler}gnarfling {filler}blotzen" then gnarfling {filler}\n"gnarfling {filler}\nblotzen"'
    assert [h[3] for h in toxicity.hits(text, lexicon)] == [True, True, False, False, False]


def test_quality_learns_from_every_label(spark):
    """Ten thousand labels: as many rows as are not held out, a mean of all of them, and weights that minimise the loss of all pairs."""
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice(("salis", "tormen", "vex.", "$$$", "PRIOT")) for _ in range(rng.randint(0, 6)))) for i in range(10_000)]
    labels = spark.createDataFrame([(i, int("$" not in t or i % 7 == 0)) for i, t in texts], "doc_id long, quality int")
    docs = documents(spark, texts, long=False)
    rows = quality.learning_rows(docs, labels).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [i for i, _ in texts if zlib.crc32(str(i).encode()) % 5]
    x, good = np.array([r["features"] for r in rows]), np.array([r["label"] == 1 for r in rows])
    model, here = quality.fit(docs, labels), quality.Ranking(x, good)
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-6)
    assert (model.w == here.w).all() and model.cut == here.cut and model.slope == here.slope
    z = (x - model.mean) / model.scale
    at = z @ model.w
    missed = learn.sigmoid(at[~good][None, :] - at[good][:, None])
    slope = (missed.sum(axis=0) @ z[~good] - missed.sum(axis=1) @ z[good]) / missed.size + 1e-3 * model.w
    assert np.abs(slope).max() < 1e-4
    assert model.cut == pytest.approx(np.quantile(at, np.mean(~good)), abs=1e-6)
