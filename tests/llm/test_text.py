import random

from tests.llm import brute
import numpy as np
import public_tokenizers
import pytest

from mediaweave.llm import _spans, pii, quality, secrets, toxicity


def check_spans(rows, docs, kinds):
    for r in rows:
        want = brute.spans(docs[r.doc_id], kinds)
        assert r.base_sha256 == _spans.digest(want)
        assert set(_spans.joined(want).split(",")) <= set(r.spans.split(","))


def test_base_spans_of_random_text():
    r = random.Random(2)
    for _ in range(400):
        t = "".join(r.choice(["4111111111111111", "+1 (017) 555-7713", "a@b.c", "@", ".", "1.2.3.4", "300.1.1.1", "-", " ", "0", "7", "tokeN=", "API_key: \"", "AKIA", "abcdef0123456789", "Zz9", "é", "+", "("]) for _ in range(r.randrange(25)))
        assert _spans.base_spans(t, _spans.PERSONAL) == brute.spans(t, brute.PERSONAL)
        assert _spans.base_spans(t, _spans.SECRET) == brute.spans(t, brute.SECRET)


def test_pii(spark, data, odd, empty):
    docs = spark.read.parquet(f"{data}/documents.parquet").union(odd.select("doc_id", "text", "lang", "source", "n_chars").selectExpr("doc_id + 100000", "text", "lang", "source", "n_chars"))
    check_spans(pii.find_pii(docs).collect(), {r.doc_id: r.text for r in docs.collect()}, brute.PERSONAL)
    assert pii.find_pii(empty).count() == 0


def test_field_finds_added_kinds():
    model = pii.trained()
    hit = total = wrong = 0
    for text, gold in pii.training_cases(200, seed=99):
        want = {(t, s, e) for s, e, t in gold if t in pii.ADDED}
        got = set(pii.field_spans(text, model))
        hit, total, wrong = hit + len(want & got), total + len(want), wrong + len(got - want)
    assert hit >= 0.8 * total and wrong <= 0.03 * total


def test_field_in_texts_of_the_table(data):
    """Invented personal data put into texts of the table: at least 85 % found with exact bounds, at most 2 % of what is found is none."""
    import pyarrow.parquet as pq

    r = random.Random(5)
    plain = [t for t in pq.read_table(f"{data}/documents.parquet")["text"].to_pylist() if t and len(t) < 8000]
    field, texts, wanted = pii.Field(pii.trained().weights), [], []
    for k, (case, gold) in enumerate(pii.training_cases(300, seed=77)):
        text = plain[k % len(plain)]
        at = max(0, text.find(" ", r.randrange(len(text))))
        texts.append(f"{text[:at]} {case} {text[at:]}")
        wanted.append({(t, s + at + 1, e + at + 1) for s, e, t in gold if t in pii.ADDED})
    found = [set(x) for x in field.spans(texts)]
    right, total, said = sum(len(a & b) for a, b in zip(found, wanted, strict=True)), sum(map(len, wanted)), sum(map(len, found))
    assert right >= 0.85 * total and right >= 0.98 * said
    assert sum(map(len, field.spans(plain))) <= len(plain) / 200


def test_tokens_and_their_classes_are_those_of_the_pattern():
    field, r = pii.Field(pii.trained().weights), random.Random(1)
    texts = ["".join(r.choice("aB \u00e9\u00b2\u0663_\n\t\u4e2d\u01c5\u00aa\u00ba9 0.@(\u017fK\u212a\U0001d7d8") for _ in range(r.randrange(1, 30))) for _ in range(500)]
    for t in [*texts, *(f"{w} {w.upper()} {w.title()}s {w}{w}" for w in pii._WORD_LIST), "9" * 700]:
        codes = np.frombuffer(t.encode("utf-32-le"), "<u4").astype(np.int64)
        start, end, key = pii.cut_tokens(codes)
        want = pii.tokens(t, 0, len(t))
        assert list(zip(start.tolist(), end.tolist(), strict=True)) == [x[:2] for x in want]
        assert field.kinds(t, start, end, key).tolist() == [field._class(x) for *_, x in want]


def test_spans_apart_are_those_that_overlap_no_base_span():
    r = random.Random(3)
    for _ in range(300):
        make = lambda n: [(k, s, s + r.randint(1, 9)) for k, s in ((r.choice("ab"), r.randrange(60)) for _ in range(n))]
        base, more = sorted(make(r.randrange(6)), key=lambda x: x[1]), make(r.randrange(9))
        assert _spans.apart(base, more) == [x for x in more if not any(x[1] < e and s < x[2] for _, s, e in base)]


@pytest.mark.parametrize("kind, text", [
    ("street", "he lives at |12 Old Mill Road| now"), ("ssn", "her SSN |123 45 6789| is here"), ("masked_email", "mail |john.smith (at) example (dot) com| now"),
    ("masked_email", "contact |berta (AT) example (DOT) org| soon"), ("iban", "iban |MT84 MALT 0110 0001 2345 MTLC AST0 01S| now"),
])
def test_field_reads_forms_that_no_cue_lists(kind, text):
    a, b, c = text.split("|")
    assert (kind, len(a), len(a) + len(b)) in pii.field_spans(a + b + c, pii.trained())


def test_field_tables_score_every_segment_and_bounds_lose_none(data):
    import pyarrow.parquet as pq

    model = pii.trained()
    field = pii.Field(model.weights)
    texts = ["a Dr. Mo Li, 12 Old Mill Road\n4111 1111 1111 1111 and DE12 3456 7890 1234 5678 x (at) b.com @ 99", "", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    texts += [t[:600] for t in pq.read_table(f"{data}/documents.parquet")["text"].to_pylist()[:8]]
    for text in texts:
        toks, held = pii.tokens(text, 0, len(text)), pii._Tokens(field, [text])
        want = {(i, j, t): x for i, j, t, x, _ in model.scores(toks, text)}
        starts = np.arange(len(toks))
        got = {(i, i + n, t): v for n, at, x in (held.scored(starts) if toks else ()) for i, row in zip(at.tolist(), x.tolist(), strict=True) for t, v in zip(pii.TYPES, row, strict=True)}
        assert want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-3 for k in want)
        near = {(i, i + n) for n, at, x in (held.scored(starts, held._bounds()) if toks else ()) for i in at.tolist()}
        assert all(k[:2] in near for k, x in want.items() if x > 0 and k[2] in pii.ADDED)


def test_dynamic_programme_is_the_best_of_all_segmentations():
    model = pii.SemiMarkov({t: {"1": -1.0, "f93": 2.0 if t == "ssn" else 0.0, "n5": 1.5 if t == "ssn" else -1.0} for t in pii.TYPES})
    text = "a 123-45-6789 b"
    toks = pii.tokens(text, 0, len(text))
    score = {(i, j, t): x for i, j, t, x, _ in model.scores(toks, text)}

    def best(at):
        if at == len(toks):
            return 0.0
        return max([best(at + 1), *(x + best(j) for (i, j, _), x in score.items() if i == at)])

    assert abs(sum(score[s] for s in model.best(toks, text)) - best(0)) < 1e-9
    mass = {k: p for *k, p, _ in model.marginals(toks, text)[1] for k in [tuple(k)]}
    assert all(0 <= p <= 1 for p in mass.values())


def test_secrets(spark, data, odd, empty):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    check_spans(secrets.find_secrets(spark, docs).collect(), {r.doc_id: r.text for r in docs.collect()}, brute.SECRET)
    assert secrets.find_secrets(spark, odd).count() == 17 and secrets.find_secrets(spark, empty).count() == 0
    clean = {r.doc_id: r for r in secrets.redact(spark, odd).collect()}
    assert "abcdEFGH1234ijkl" not in clean[14].text and clean[0].text is None and clean[5].text == odd.where("doc_id = 5").first().text
    assert secrets.redact(spark, odd).columns == odd.columns


def _found(texts):
    """Per text its discoveries, with the false-discovery step over all texts."""
    every = [[(*x[:3], secrets._bin(x[3])) for x in secrets.candidates(t)] for t in texts]
    counts = {}
    for x in (x for found in every for x in found):
        counts[x[3]] = counts.get(x[3], 0) + 1
    least = secrets.cut(counts)
    return [secrets.discoveries(found, least) for found in every]


def test_random_strings_stand_out():
    r = random.Random(4)
    names = ["thisIsAnOrdinaryIdentifierOfSomeLength", "internationalizationAndLocalization", "src/main/java/org/example/application", "AVERYLONGCONSTANTNAMEWITHWORDSONLY2", "donaudampfschifffahrtsgesellschaft"]
    for name, n, least in (("base62", 64, 0.9), ("base62", 48, 0.7), ("hex", 64, 0.9), ("base64url", 80, 0.7)):
        keys = ["".join(r.choice(secrets.ENCODINGS[name]) for _ in range(n)) for _ in range(60)]
        found = _found([*keys, *names])
        assert sum(any(e - s >= n - 24 for _, s, e in x) for x in found[:60]) >= least * 60 and not any(found[60:])


def test_random_parts_of_paths_stand_out():
    r = random.Random(5)
    keys = ["".join(r.choice(secrets.ENCODINGS["base62"]) for _ in range(64)) for _ in range(40)]
    texts = [f"see https://host.example.org/api-v1/item_list/{k}/view now" for k in keys]
    hits = sum(("random", t.index(k), t.index(k) + 64) in x for t, k, x in zip(texts, keys, _found(texts), strict=True))
    assert hits >= 32
    assert (21, 49, "base64url") in secrets.parts("a" * 20 + "/" + "B-" * 12 + "_" + "z7" + "d")  # marks of both alphabets: cut at the foreign ones


def test_share_of_false_discoveries(data):
    """Random strings and ordinary ones put into texts of the table, one to nine: few of the discoveries are ordinary or the table's own."""
    import pyarrow.parquet as pq

    r = random.Random(6)
    plain = [t for t in pq.read_table(f"{data}/documents.parquet")["text"].to_pylist() if t and not _spans.base_spans(t, _spans.SECRET) and len(t) < 6000]
    false = true = planted = 0
    texts, golds = [], []
    for k in range(1500):
        name = r.choice(["base62", "base64", "base64url", "base36", "base32"])
        n = r.choice([20, 32, 48, 64, 80])
        secret = k % 10 == 0
        key = "".join(r.choice(secrets.ENCODINGS[name]) for _ in range(n)) if secret else secrets._ordinary(r, name, n)
        text = plain[k % len(plain)] if k < 3 * len(plain) else ""
        texts.append(f"{text} {key} end")
        golds.append((len(text) + 1, len(text) + 1 + n) if secret else None)
        planted += secret and n >= 64
    for gold, found in zip(golds, _found(texts), strict=True):
        for _, s, e in found:
            good = gold is not None and gold[0] <= s and e <= gold[1]
            true, false = true + good, false + (not good)
    assert true >= 0.4 * planted and false <= 0.05 * (true + false) + 1


def test_null_holds_in_its_own_tail():
    r = random.Random(7)
    for name, n in (("base62", 32), ("base64", 24), ("lower", 20), ("hex", 48)):
        fresh = [x for x in (secrets._ordinary(r, name, n) for _ in range(6000)) if secrets.encoding(x) == name]
        ps = sorted(secrets.looks_ordinary(secrets.strength(x, name)[0], name, n) for x in fresh)
        for level in (0.05, 0.01, 0.002):
            assert sum(p <= level for p in ps) <= 1.6 * level * len(ps) + 3
        many = secrets.strengths(np.array([[secrets._PLACE[name][c] for c in x] for x in fresh[:200]]), len(secrets.ENCODINGS[name]))
        assert np.allclose(many, [secrets.strength(x, name)[0] for x in fresh[:200]])


def test_secrets_of_long_texts_take_linear_time(spark):
    import time

    took = []
    for n in (4_000, 16_000):
        text = " ".join(f"token = 'abcd{k:012d}' someOrdinaryName{k:04d}" for k in range(n))
        began = time.process_time()
        fixed = _spans.base_spans(text, _spans.SECRET)
        found = _spans.apart(fixed, secrets.candidates(text))
        secrets.discoveries([(*x[:3], 5) for x in found], 0)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.5


def test_false_discovery_step():
    assert secrets.cut({0: 100}) > 10_000
    assert secrets.cut({80: 5, 0: 95}) == 80


def test_quality(spark, data, odd, empty):
    for docs in (spark.read.parquet(f"{data}/documents.parquet"), odd):
        out = quality.weak_quality(spark, docs).collect()
        by = {r.doc_id: r.text for r in docs.collect()}
        assert len(out) == docs.count()
        for r in out:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(by[r.doc_id])
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)
    assert quality.weak_quality(spark, empty).count() == 0


def test_expectation_maximisation_finds_the_accuracies():
    r = np.random.default_rng(0)
    truth = r.random(20_000) < 0.8
    right = [0.9, 0.8, 0.6, 0.95]
    votes = np.stack([np.where(r.random(20_000) < 0.2, 0, np.where((r.random(20_000) < a) == truth, 1, -1)) for a in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, hit = quality.fit(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.03
    assert np.allclose(hit[1], right, atol=0.04) and np.allclose(hit[0], right, atol=0.06)
    known = (quality.posterior(votes, share, hit) >= 0.5) == truth
    assert known.mean() > 0.94


def test_toxicity(spark, data, odd, empty):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    made = [(i, f"some plain words about number {i} and things " + ("you utter blockhead" if i % 3 == 0 else "a fine day")) for i in range(300)]
    d = spark.createDataFrame(made, "doc_id long, text string")
    lab = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(spark, d, lab).collect()
    held = [r for r in out if r.held_out]
    assert held and all(r.predicted == int(r.doc_id % 3 == 0) for r in held)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    odd_out = toxicity.toxicity(spark, odd, lab).collect()
    assert len(odd_out) == 17 and all(0 <= r.score <= 1 for r in odd_out)
    model = toxicity.fit(toxicity.sample(d, lab))
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.where("text is null").count() == 1
    assert toxicity.toxicity(spark, empty, labels).count() == 0
    none = labels.limit(0)
    assert {r.predicted for r in toxicity.toxicity(spark, d, none).collect()} <= {0, 1}


def test_grams_and_scores_are_those_of_a_plain_version():
    import math

    import pyarrow as pa

    from mediaweave.llm._common import text_bytes

    mask = (1 << 64) - 1

    def mixed(x):
        x ^= x >> 31
        x = x * 0xBF58476D1CE4E5B9 & mask
        x ^= x >> 29
        x = x * 0x94D049BB133111EB & mask
        return x ^ (x >> 32)

    def plain(text):
        data, out = brute.lower(text).encode(), set()
        for n in toxicity.SIZES:
            for i in range(len(data) - n + 1):
                h = n
                for b in data[i : i + n]:
                    h = h * 0x100000001B3 + (b + 1) * 0x9E3779B97F4A7C15 & mask
                out.add(mixed(h) >> 64 - toxicity.BUCKETS.bit_length() + 1)
        return out

    r = random.Random(8)
    words = [x + y for x in "THe a É idiot of".split() for y in "re|sh|\n| |.".split("|")]
    for sizes in ([0, 1, 3], [2, 20, 0, 400], [30_000, 5, 0, 9_000], [0]):  # the longest go over several spans
        texts = [" ".join(r.choice(words) for _ in range(k)) for k in sizes]
        of, bucket = toxicity.gram_buckets(*text_bytes(pa.array(texts)))
        want = [plain(t) for t in texts]
        assert [set(bucket[of == k].tolist()) for k in range(len(texts))] == want
        assert len(of) == sum(map(len, want)) and (np.diff(of) >= 0).all()
        weights = np.where(np.arange(toxicity.BUCKETS) % 7 == 0, (np.arange(toxicity.BUCKETS) % 13 - 6) / 40, 0.0)
        scores = toxicity.Model(weights, -0.25).scores(pa.array(texts))
        assert np.allclose(scores, [1 / (1 + math.exp(0.25 - sum(weights[b] for b in w))) for w in want])


def test_toxicity_over_folds(spark, data):
    """Each of five folds of the labelled rows is scored by a fit on the other four. Labels that disagree between equal texts are noise."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data.replace('0.001', '0.01')}/documents.parquet").collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{data.replace('0.001', '0.01')}/labels.parquet").collect() if r.doc_id in docs]
    rows = [(i, docs[i] or "", y) for i, y in labels]
    wrong = clean = 0
    for fold in range(5):
        model = toxicity.fit(spark.createDataFrame([x for k, x in enumerate(rows) if k % 5 != fold], "doc_id long, text string, toxic int"))
        import pyarrow as pa

        held = [x for k, x in enumerate(rows) if k % 5 == fold]
        for (_, _, y), p in zip(held, model.scores(pa.array([x[1] for x in held])), strict=True):
            clean, wrong = clean + (y == 0), wrong + (y == 0 and p >= 0.5)
    assert wrong <= 0.03 * clean


def test_toxicity_weighs_classes_by_their_share_at_every_size(spark):
    made = [(i, "one and the same plain text") for i in range(900)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 9 == 0)) for i in range(900)], "doc_id long, quality int, toxic int")
    score = [toxicity.toxicity(spark, docs, labels, per_class).first().score for per_class in (40, 4000)]
    assert all(0.08 < x < 0.15 for x in score) and abs(score[0] - score[1]) < 0.01


def test_tokenizer_paths():
    assert public_tokenizers.path("byte_bpe_50k.json").endswith("byte_bpe_50k.json")


if __name__ == "__main__":
    pytest.main([__file__])
