import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelcraft.llm import langid_kn, pii_patterns, pseudo_likelihood, queries, semicrf, ssk_svm
from panelcraft.llm.common import remainder

from .conftest import ODD

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_are_the_patterns():
    rng = np.random.default_rng(9)
    for _ in range(400):
        text = "".join(rng.choice(list("a1.@+- ()45%Z\n"), 60))
        assert pii_patterns.base_spans(text) == plain_spans(text)
    assert pii_patterns.base_spans("4111 1111-1111 1111, x@@a.b@c.d 1.2.3.4.5.6.7.8") == \
        plain_spans("4111 1111-1111 1111, x@@a.b@c.d 1.2.3.4.5.6.7.8")


def test_personal_data_of_all_documents(real):
    got = {r["doc_id"]: r for r in semicrf.digest(semicrf.find(real, semicrf.fit(real))).collect()}
    for r in real.collect():
        line = ",".join(f"{pii_patterns.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(r["text"] or ""))
        own = got[r["doc_id"]]
        assert own["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(own["spans"].split(","))


def test_field_learns_disguises_and_sums_to_one(real):
    texts = [r["text"] for r in real.collect() if semicrf.TRIGGER.search(r["text"] or "")]
    weight = semicrf.train(texts)
    lattice = semicrf.Lattice("a mail x.5@b.c now", [(0, 1), (2, 6), (7, 14), (15, 18)])
    expected = lattice.expected(lattice.scores(weight))
    for t in range(lattice.n):  # every token lies in just one segment
        assert sum(expected[s].sum() for s, (i, j, _) in enumerate(lattice.segments) if i <= t < j) == pytest.approx(1)
    text = "then the card 4111.1111.1111.1111 was there"
    assert [(text[a:b], k) for a, k, b in semicrf.added_spans(text, weight, [])] == [("4111.1111.1111.1111", 2)]
    assert semicrf.added_spans("no data in here", weight, []) == [] and semicrf.train(["none"]) is None


def test_models_on_odd_rows(spark, odd, real):
    machine = ssk_svm.fit(real, spark.read.parquet(f"{SF}/labels.parquet"))
    model = langid_kn.fit(langid_kn.labelled(real))
    for got in (ssk_svm.score(odd, machine), langid_kn.identify(odd, model), pseudo_likelihood.score(odd, ["the"], pseudo_likelihood.start_weights()),
                semicrf.find(odd, None), ssk_svm.score(odd, None), langid_kn.identify(odd, None)):
        assert got.count() == len(ODD)
    by_id = {r["doc_id"]: r for r in langid_kn.identify(odd, model).collect()}
    assert all(by_id[i]["lang_pred"] == "und" and not by_id[i]["accepted"] for i in (1, 2, 8))
    assert ssk_svm.keep_clean(odd, machine).columns == odd.columns and semicrf.redact(odd, None).count() == len(ODD)
    assert langid_kn.fit(langid_kn.labelled(real.limit(0))) is None
    assert ssk_svm.fit(real, spark.createDataFrame([], "doc_id long, toxic int")) is None


def test_language_is_learned(real):
    rows = [r for r in real.collect() if r["lang"]]
    model = langid_kn.train([r["text"] for r in rows if remainder(r["doc_id"], 3) != 1], [r["lang"] for r in rows if remainder(r["doc_id"], 3) != 1])
    held = [r for r in rows if remainder(r["doc_id"], 3) == 1]
    assert np.mean([p[0] == r["lang"] for p, r in zip(model.predict([r["text"] for r in held]), held)]) > 0.95
    context = np.uint64(ord("t")) << np.uint64(32) | np.uint64(ord("h")) << np.uint64(16) | np.uint64(ord("e"))
    symbols = np.unique(langid_kn.symbols([r["text"] for r in rows])[0])
    grams = (context << np.uint64(16)) | symbols
    assert (np.exp2(model.log2(np.sort(grams))).sum(axis=0) < 1.001).all()


def test_kernel_is_the_sum_over_subsequences():
    def plain(a, b):
        def weights(w):
            out = {}
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, min(len(w), i + ssk_svm.SPAN)):
                        key = w[i] + w[j] + w[k]
                        out[key] = out.get(key, 0) + ssk_svm.DECAY ** (k - i + 1)
            return out
        x, y = weights(a), weights(b)
        n = ssk_svm.norms(np.array([len(a), len(b)]))
        return sum(v * y.get(k, 0) for k, v in x.items()) / n[0] / n[1]

    marks, words = ["idiot", "clown", "scum"], ["idiot", "i.d.i.o.t", "idixot", "table", "scums", "ab"]
    got = ssk_svm.Landmarks(marks).kernel(words)
    assert np.allclose(got, [[plain(w, m) for m in marks] for w in words])


def test_insults_with_inserted_characters():
    rng = np.random.default_rng(1)
    plain = ["the", "table", "stands", "here", "and", "there", "rivers", "flow", "over", "stones", "window", "garden"]
    texts = [" ".join(rng.choice(plain, 20)) for _ in range(200)]
    toxic = [int(k % 3 == 0) for k in range(200)]
    texts = [t + " " + rng.choice(["idiot", "moron", "clown"]) if y else t for t, y in zip(texts, toxic)]
    machine = ssk_svm.train(texts, toxic)
    score = machine.scores(["the table idiot stands", "the i.d.i.o.t stands", "the mor-on flows", "a m o r o n here", "the garden window stands"])
    assert (score[:4] >= 0.3).all() and score[4] < 0.3


def test_windows_network_learns_both_sides(spark):
    text = "a b c a b c a b c d e f d e f d e f"
    docs = spark.createDataFrame([(k, text) for k in range(50)], "doc_id long, text string")
    words, weights = pseudo_likelihood.train(docs)
    assert set(words) == set("abcdef")
    p = np.exp(pseudo_likelihood.log_probabilities(weights, np.arange(2_000)))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    mixed = spark.createDataFrame([(0, text), (1, "c b a f a d b e c"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pseudo_likelihood.score(mixed, words, weights).collect()}
    assert got[0]["mean_log_prob"] > got[1]["mean_log_prob"] + 0.5 and got[2]["n_words"] == 0 and got[2]["log_prob"] == 0
    coder = pseudo_likelihood.Coder(words)
    code = coder.code(text)
    want = sum(pseudo_likelihood.log_probabilities(weights, np.array([code[i - 1] << 8 | code[i + 1]]))[0, code[i]] for i in range(1, len(code) - 1))
    assert got[0]["log_prob"] == pytest.approx(want, abs=1e-3)


@pytest.mark.parametrize("frequent", [40, 1 << 17])
def test_every_word_has_its_share_of_its_class(spark, frequent):
    rng = np.random.default_rng(3)
    common = [f"c{a}{b}" for a in "bdfgklmnprst" for b in "abcdefghijklmnopqrst"]
    rare = [f"stone{a}{b}" for a in "bdfgk" for b in "lmnpr"]
    texts = [" ".join(rng.permutation(common)) + " " + " ".join(rng.choice(rare, 8)) for _ in range(20)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    counted = pseudo_likelihood.count_words(docs)
    words, weights = pseudo_likelihood.train(docs, counted)
    shares = pseudo_likelihood.share_out(counted, words, frequent)
    assert (shares.rare.count() > 0) == (frequent == 40)
    mixed = ["stonebl cba stonegm", "stoneqq cba stonezz", "Stonebl " * 3 + "tt, newword", None, texts[0], texts[0]]
    odd = spark.createDataFrame([(k % 5, t) for k, t in enumerate(mixed)], "doc_id long, text string")
    got = [r["log_prob"] for r in pseudo_likelihood.score(odd, words, weights, shares=shares).sort("doc_id", "n_words").collect()]
    plain = [r["log_prob"] for r in pseudo_likelihood.score(odd, words, weights).sort("doc_id", "n_words").collect()]
    order = sorted(range(6), key=lambda k: (k % 5, len((mixed[k] or "").split())))
    n = Counter(w for t in texts for w in t.split())
    total = Counter()
    for w, k in n.items():
        total[pseudo_likelihood.make_up(w)] += 0 if w in words else k
    for have, base, k in zip(got, plain, order):
        own = [w for w in (mixed[k] or "").lower().split() if w not in words]
        assert have == pytest.approx(base + sum(np.log(max(1, n[w]) / (total[pseudo_likelihood.make_up(w)] + 1)) for w in own), abs=1e-6)
    score = dict(zip(order, got))
    assert dict(zip(order, plain))[0] == pytest.approx(dict(zip(order, plain))[1])  # same shapes
    assert score[0] > score[1] + 2 and score[4] == score[5]


def test_the_most_frequent_words_go_to_the_tasks(spark):
    n = {f"w{k}": 6_000 // k for k in range(1, 1_001)}
    shares = pseudo_likelihood.share_out(spark.createDataFrame([*n.items()], "word string, n long"), ["w1", "w2"], 500)
    assert shares.logs == {w: pytest.approx(np.log(k) if w not in ("w1", "w2") else 0) for w, k in n.items() if k >= 12}
    assert len(shares.logs) == 500 and {r["word"] for r in shares.rare.collect()} == {w for w, k in n.items() if k < 12}


def test_texts_are_read_twice(spark, real, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def touch(text):
        seen.add(1)
        return text

    docs = real.limit(200).select("doc_id", F.udf(touch, "string").asNondeterministic()("text").alias("text"))
    monkeypatch.setattr(queries, "documents", lambda spark, sf_dir: docs)
    assert queries.op8_pseudo_likelihood(spark, SF).count() == 200
    assert seen.value == 400


def test_codes_are_those_of_single_words(spark, odd):
    words = ["the", "twice", "ab", "a1b", "x9", "9", ".", "..", "a.", "-a", "ab-c", "é", "é.", "²", "a²", "ß1", "日本", "٣", "a٣", "straße",
             "eightlet", "nineletts", "z" * 15, "z" * 16, "I.", "a,", "abcdefgh,", "1a", "a11", "\x00"]
    assert pseudo_likelihood.make_ups(pa.array(words)).tolist() == [*map(pseudo_likelihood.make_up, words)]
    assert pseudo_likelihood.make_ups(pa.array(words)[5:12]).tolist() == [*map(pseudo_likelihood.make_up, words[5:12])]
    logs, floors = {"the": 0.0, "twice": 3.0, "over": 2.0}, -np.arange(256) / 8
    coder = {"the": 1} | {w: pseudo_likelihood.make_up(w) for _, t in ODD for w in (t or "").lower().split() if w != "the"}
    got = pseudo_likelihood.coded(odd, ["the"], pseudo_likelihood.Shares(logs, floors, None)).sort("row").collect()
    assert len(got) == len(ODD)
    for r in got:
        own = next((t or "").lower().split() for k, t in ODD if k == r["doc_id"])
        assert [*r["codes"]] == [0, *map(coder.get, own), 0] and r["n_words"] == len(own)
        assert r["rare"] == [w for w in own if w not in logs]
        assert r["log_share"] == pytest.approx(sum(logs.get(w, 0) + floors[coder[w]] for w in own))


def entity_texts():
    rng = np.random.default_rng(6)
    names, hosts = ["ann", "bob.k", "eve", "max.d", "zoe"], ["mail.org", "post.example.org", "a.b.example.net", "site.com"]
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "340000000000009", "6011000000000004"]
    out = []
    for k in range(240):
        kind, n = k % 4, rng.integers(1, 250, 4)
        value = [f"{names[k // 4 % 5]}{k}@{hosts[k // 4 % 4]}", ".".join(map(str, n)), cards[k // 4 % 4], f"+1 {200 + k} 555 {1000 + k}"][kind]
        out.append(f"please note that {value} belongs to the entry number {k} of our long list of people")
    return out


def test_plain_numbers_crowd_out_no_kind(spark):
    rng = np.random.default_rng(8)
    long = " ".join(f"in the year {n} there were many more people" for n in rng.integers(0, 10 ** 6, 5_000))
    plain = [f"on day {k} of the long month nothing else was written" for k in range(1_500)]
    texts = [long, *plain, *entity_texts()]
    assert {kind for kind, *_ in semicrf.teachers(long)} == {semicrf.OTHER} and len(semicrf.teachers(long)) <= semicrf.FIT_EACH
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(3)
    for weight in (semicrf.train(texts), semicrf.fit(docs)):
        for value, kind in (("4111.1111.1111.1111", 2), ("ann[at]mail[dot]org", 0), ("10[.]20[.]30[.]40", 1)):
            text = f"please note that {value} belongs to the entry"
            assert [(text[a:b], k) for a, k, b in semicrf.added_spans(text, weight, [])] == [(value, kind)]
    assert np.array_equal(semicrf.fit(docs), semicrf.fit(docs.repartition(5)))


def test_disguises_of_many_tokens_are_found_whole():
    weight = semicrf.train(entity_texts())
    for value in ("ann [at] mail [dot] example [dot] org", "bob.k [at] post [dot] a [dot] example [dot] net"):
        text = f"please note that {value} belongs to the entry"
        assert [(text[a:b], k) for a, k, b in semicrf.added_spans(text, weight, [])] == [(value, 0)]
    digits = " ".join(f"{d}," for d in "4111111111111111")
    bounds = [m.span() for m in semicrf.TOKEN.finditer(digits)]
    assert (0, 16, True) in semicrf.Lattice(digits, bounds).segments
    assert semicrf.gold(digits, bounds, [(0, 2, len(digits))]) == {(0, 16): 2}
    long = " ".join(str(k % 97) for k in range(2_000))
    tokens = semicrf.regions(long)[0]
    whole = semicrf.Lattice(long, tokens)
    parts = [semicrf.Lattice(long, tokens, a, min(2_000, a + semicrf.BLOCK)).segments for a in range(0, 2_000, semicrf.BLOCK)]
    assert whole.segments == [x for own in parts for x in own]


def test_letters_decide_what_has_a_language(spark, documents):
    from panelcraft.llm import langid_kn

    teach = [(i, t, n) for i, (t, n) in enumerate([("the cat sat on the mat", "en"), ("der hund und die katze", "de"),
                                                   ("𠀋𠀌 𠀍𠀎𠀏 𠀋𠀍", "zz")] * 12)]
    model = langid_kn.fit(spark.createDataFrame(teach, "doc_id long, text string, lang string"))
    asked = documents([(1, "½ ²"), (2, "12 _ ٣"), (3, "𠀋𠀍𠀎 𠀌"), (4, None), (5, "the mat"), (6, "ª")])
    got = {r["doc_id"]: r["lang_pred"] for r in langid_kn.identify(asked, model).collect()}
    assert got[1] == got[2] == got[4] == "und" and got[3] == "zz" and got[5] == "en" and got[6] != "und"
