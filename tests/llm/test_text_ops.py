"""Piece encoding, language id, quality, fingerprints, scoring: brute force, round trips and odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from flowguard.llm import fingerprints, language, pieces, quality, scoring, shingles
from flowguard.llm.catalog import piece_model

ODD = [(1, None, "en", "a", "x"), (2, "", "fr", "b", "x"), (3, "123 !!", None, "c", "x"), (3, "123 !!", None, "c", "x"),
       (4, "hello there", "en", "a", "x"), (5, "bonjour é", None, None, "x"), (None, "bonjour é", None, None, "x"), (9, "word " * 30000, "en", "a", "x")]


@pytest.fixture(scope="module")
def odd(spark):
    # extra columns carry the names of results
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, score string")


def test_pieces_equal_the_library():
    import sentencepiece

    path = piece_model()
    sp, m, rnd = sentencepiece.SentencePieceProcessor(model_file=path), pieces.merges(path), random.Random(1)
    parts = ["a", "th", "e", " ", "  ", "▁", "\n", "\t", "é", "日", "😀", "\x00", "<s>", "</s>", "<0x41>", "aaa", "ing", "​", "12", "----", ".", ", "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(4000)] + ["ab" * 20000, ""]
    for t in texts:
        ids = m.encode(t)
        assert ids == sp.encode(t, add_bos=True, add_eos=True)
        assert m.decode(ids) == sp.decode(ids)
    for _ in range(3000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), 0, 1, 2]) for _ in range(rnd.randint(0, 8))]
        assert m.decode(ids) == sp.decode(ids)


def test_pieces_rows(odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    got = pieces.encode_decode(odd, piece_model()).collect()
    want = [sp.encode(t or "", add_bos=True, add_eos=True) for _, t, *_ in ODD]
    assert sorted(r["ids"] for r in got) == sorted(want) and all(r["round_trip"] for r in got)
    assert pieces.encode_decode(odd.limit(0), piece_model()).count() == 0


def test_language(spark, odd):
    en, fr = "the cat and the dog are here today", "le chat et le chien sont ici avec nous"
    rows = spark.createDataFrame([(i, (en, fr)[i % 2] + f" {i}", ("en", "fr")[i % 2], "s") for i in range(60)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in language.identify(rows).collect()}
    assert all(r["lang_pred"] == ("en", "fr")[k % 2] and 0.5 <= r["score"] <= 1 for k, r in got.items())
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    got = language.predict(odd, language.train(rows)).collect()
    assert len(got) == len(ODD) and got[0].asDict().keys() == {"doc_id", "text", "lang", "source", "lang_pred", "score"}
    for r in got:
        assert (r["lang_pred"] == "und" and r["score"] == 0) == (not any(c.isalpha() for c in r["text"] or ""))
    assert language.identify(rows.limit(0)).count() == 0


def _plain_buckets(text):
    """Hashed n-grams of one text, one after the other."""
    a, out, mask = [0, 0] + [ord(c) for c in text.lower()], [], (1 << 32) - 1
    a += [0, 0]
    for at in range(len(a) - 2):
        h = 0
        for k in range(3):
            h = ((h ^ a[at + k]) * 0x9E3779B1 + k + 1) & mask
            h ^= h >> 15
            out.append(((h * 0x85EBCA77) & mask) >> 16)
    return out


def _plain_bayes(rows, texts):
    counts, docs = collections.defaultdict(collections.Counter), collections.Counter()
    for t, lang in rows:
        docs[lang] += 1
        counts[lang].update(_plain_buckets(t or ""))
    out = []
    for t in texts:
        if not t or not any(c.isalpha() for c in t):
            out.append(("und", 0.0))
            continue
        grams = collections.Counter(_plain_buckets(t))
        logs = {k: math.log(docs[k] / sum(docs.values())) + sum(n * math.log((counts[k][g] + 0.5) / (sum(counts[k].values()) + 0.5 * 65536))
                                                               for g, n in grams.items()) for k in docs}
        best = min(logs, key=lambda k: (-logs[k], k))
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


@pytest.mark.parametrize("group, chained", [(100, 4), (2, 1)])
def test_language_equals_plain_naive_bayes(spark, monkeypatch, group, chained):
    """Every score, with one group of languages and with several; ties to the first name."""
    monkeypatch.setattr(language, "CHAINED", chained)
    rnd = random.Random(4)
    letters = {"de": "abcdeßü", "en": "abcdefg", "es": "abcdñop", "fr": "abcdeéç", "xx": "abcdefg"}
    made = lambda k, n: " ".join("".join(rnd.choices(letters[k], k=rnd.randrange(1, 7))) for _ in range(n))
    same = [made("en", 9) for _ in range(6)]
    rows = [(t, k) for k in ("en", "xx") for t in same] + [(made(k, rnd.randrange(1, 30)), k) for k in ("de", "es", "fr") for _ in range(9)] + [(None, "fr"), ("", "de")]
    texts = [made(k, rnd.choice([1, 2, 12])) for k in letters for _ in range(12)] + [None, "", "²½", "Ⅷ", "12 !?", "日本", "é", "ǅ", "x" * 5000, "ª"]
    train = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, score int")
    docs = spark.createDataFrame([(i, t, "?") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    models = language.train(train, group=group)
    assert models.langs == sorted(letters) and len(models.groups) == -(-len(letters) // group)
    got = {r["doc_id"]: r for r in language.predict(docs, models).collect()}
    for i, (lang, score) in enumerate(_plain_bayes(rows, texts)):
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - score) < 1e-4, (i, texts[i])
    assert "xx" not in {r["lang_pred"] for r in got.values()} and "en" in {r["lang_pred"] for r in got.values()}  # equal counts: a tie
    nothing = language.predict(docs, language.train(train.limit(0)))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}


def test_quality_statistics_equal_plain_python():
    rnd = random.Random(7)
    parts = ["Word", "word", "WORD", "12", "a" * 30, "é", "!!", "#", ".", "x-y"]
    texts = ["", " \n\t ", "one"] + ["".join(rnd.choice([" ", "\n", "  "]) + rnd.choice(parts) for _ in range(rnd.randrange(1, 60))) for _ in range(200)]
    got = quality.features([t.encode() for t in texts])
    for t, row in zip(texts, got):
        words, b = re.findall("[^ \t\n\x0b\x0c\r]+", t), t.encode()
        seen = [c for c in b if c not in b" \t\n\x0b\x0c\r"]
        kind = lambda chars: sum(c in chars for c in seen)  # noqa: E731, B023
        lower, upper = kind(range(97, 123)), kind(range(65, 91))
        common = kind(b".,;:'\"-?()")
        signs = sum(33 <= c < 127 and not chr(c).isalnum() for c in seen) - common
        n, many = max(1, len(seen)), max(1, len(words))
        count = collections.Counter(words)
        want = [math.log1p(len(words)), n / many, upper / max(1, lower + upper), kind(range(48, 58)) / n, common / n, signs / n, kind(range(128, 256)) / n, (lower + upper) / n,
                len(count) / many, max(count.values(), default=0) / many, sum(x == y for x, y in zip(words, words[1:])) / many, t.count("\n") / many,
                sum(len(w.encode()) > 24 for w in words) / many]
        assert np.allclose(row, want if words else 0), t


def test_quality_regression_is_at_its_optimum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, quality.N_FEATURES)) * rng.uniform(0.1, 5, quality.N_FEATURES) + 2
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1])))).astype(float)
    w, bias = quality.fit(x, y)
    p = 1 / (1 + np.exp(-(x @ w + bias)))
    z = (x - x.mean(0)) / x.std(0)
    assert abs((y - p).sum()) < 1e-3 and np.abs(z.T @ (y - p) - quality.RIDGE * w * x.std(0)).max() < 1e-6


def test_quality_posteriors_equal_plain_python(spark):
    """Strengths, host and path posteriors and scores, from the evidence and the labels, value by value."""
    rnd = random.Random(12)
    sources = ["a"] * 30 + ["b"] * 12 + ["c"] * 3 + ["d", None, "a/x", "a/y"]
    words = ["alpha", "BETA!!", "gamma", "1234", "delta."]
    docs = [(k % 190 if k else None, None if k == 5 else " ".join(rnd.choices(words, k=rnd.randrange(0, 40))), rnd.choice(["en", "fr", None]), rnd.choice(sources), "x") for k in range(240)]
    labels = [(i, int((i * 7919) % 10 < (8 if i % 3 else 3)), 0) for i in range(0, 190, 2)] + [(4, 1, 0), (6, None, 0), (8, 7, 0), (None, 1, 0)]
    got = quality.classify(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, host string"),
                           spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    known = {}
    for i, q, _ in labels:
        if i is not None and q in (0, 1):
            known[i] = max(q, known.get(i, 0))
    rows = []
    for r in got:
        held = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 == 2
        assert r["held_out"] == held
        rows.append((r["host"], r["path"], known.get(r["doc_id"], r["evidence"]) if not held else r["evidence"]))
    path, host = collections.defaultdict(list), collections.defaultdict(list)
    for h, p, y in rows:
        path[h, p].append(y)
        host[h].append(y)
    mu = (sum(y for *_, y in rows) + 1) / (len(rows) + 2)

    def strength(groups):  # (values, mean above)
        n = sum(len(v) for v, _ in groups)
        v = sum(len(v) * a * (1 - a) for v, a in groups)
        spread = sum(len(v) * (sum(v) / len(v) - a) ** 2 for v, a in groups)
        between = (spread - v / n * len(groups)) / n
        return quality.MOST if between <= 0 else min(max(v / n / between - 1, quality.LEAST), quality.MOST)
    hk = strength([(v, mu) for v in host.values()])
    above = {h: (sum(v) + hk * mu) / (len(v) + hk) for h, v in host.items()}
    pk = strength([(v, above[h]) for (h, _), v in path.items()])
    for r, (h, p, y) in zip(got, rows):
        hp = (sum(host[h]) - y + hk * mu) / (len(host[h]) - 1 + hk)
        pp = (sum(path[h, p]) - y + pk * hp) / (len(path[h, p]) - 1 + pk)
        odds = math.log(r["evidence"] / (1 - r["evidence"])) + math.log(pp / (1 - pp)) - math.log(mu / (1 - mu))
        assert abs(r["host_posterior"] - hp) < 1e-9 and abs(r["path_posterior"] - pp) < 1e-9 and abs(r["score"] - 1 / (1 + math.exp(-odds))) < 1e-9
        assert r["good"] == (r["score"] >= 0.5)
    # repeated rows get equal values, sparse sites stay nearer the prior than full ones
    assert len({(r["doc_id"], r["path"], r["evidence"]) for r in got}) <= len(got)


def test_quality(spark, odd):
    rnd = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "words", "go", "on", "here"]
    good = [" ".join(rnd.choice(words) for _ in range(60)) + "." for _ in range(60)]
    bad = [" ".join(rnd.choice(words).upper() + "!!" for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en", f"h{i % 3}") for i, t in enumerate(good + bad)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 120 and all(r["good"] == (r["doc_id"] < 60) for r in got)
    assert quality.classify(odd, labels).count() == len(ODD) and quality.classify(odd, labels.limit(0)).count() == len(ODD)
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_fingerprints(spark, odd):
    rnd = random.Random(3)
    rows = [(i, " ".join(str(rnd.randrange(5000)) for _ in range(rnd.choice([0, 3, 80, 900])))) for i in rnd.sample(range(1000), 40)]
    rows += [(2000, rows[0][1]), (1999, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(df).collect()}
    ordered = sorted(rows)
    for k, (i, t) in enumerate(ordered):
        cut, after = len(t) // 3, ordered[k - 1][1]
        edited = t[:len(t) - cut] + after[:cut]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert got[2000]["fingerprint"] == got[1999]["fingerprint"] and got[2000]["near_next"] == 1
    assert fingerprints.fingerprints(odd).count() == len(ODD) and fingerprints.fingerprints(df.limit(0)).count() == 0


def spark_hash(words):
    """Spark's xxhash64 of several strings: each word's hash is the next one's seed."""
    import xxhash

    seed = 42
    for w in words:
        seed = xxhash.xxh64(w.encode(), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def shingle_set(text, n=5):
    ws = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    if len(ws) >= n:
        return {spark_hash(ws[i:i + n]) for i in range(len(ws) - n + 1)}
    return {spark_hash([" ".join(ws)])} if ws else set()


def retained(hashes, scale):
    return {h for h in hashes if h < -(1 << 63) + (1 << 64) // scale}


@pytest.mark.parametrize("scale", [2, 8])
def test_sketches_equal_brute_force(spark, scale):
    """Which hashes are kept, what is estimated from them alone, and that parts merge."""
    rnd = random.Random(scale)
    base = [str(rnd.randrange(3000)) for _ in range(900)]
    rows = [(i, " ".join(base[rnd.randrange(500):][:rnd.choice([0, 2, 5, 30, 400])])) for i in range(0, 60, 2)]
    rows += [(7, None), (11, "é ü"), (12, "é ü"), (12, "other words here"), (None, " ".join(base[:300])), (None, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, h string, fingerprint string")
    got = fingerprints.fingerprints(df, scale=scale)
    assert got.count() == len(rows)
    ids = sorted({i for i, _ in rows if i is not None})
    least = {i: min(t or "" for j, t in rows if j == i) for i in ids}
    want = collections.Counter()

    def near(a, b, same):
        return 1.0 if same else len(a & b) / len(a | b) if a | b else 0.0

    def inside(a, b, same):
        return 1.0 if same else len(a & b) / len(a) if a else 0.0
    for i, t in rows:
        t = t or ""
        nx = least[ids[ids.index(i) - 1]] if i is not None else t
        edited = t[:len(t) - len(t) // 3] + nx[:len(t) // 3]
        h, eh, nh = map(shingle_set, (t, edited, nx))
        s, es, ns = (retained(x, scale) for x in (h, eh, nh))
        prints = [hashlib.md5(x.encode()).hexdigest() + ":" + ",".join(f"{v % (1 << 64):x}" for v in sorted(y)) for x, y in ((t, s), (edited, es))]
        values = [f(a, b, same) for a, pairs in ((s, ((es, t == edited), (ns, t == nx))), (h, ((eh, t == edited), (nh, t == nx))))
                  for f in (near, inside) for b, same in pairs]
        want[(i, *prints, *(round(v, 9) for v in values))] += 1
    names = [f"{e}{f}_{k}" for e in ("", "exact_") for f in ("near", "in") for k in ("edited", "next")]
    assert collections.Counter((r["doc_id"], r["fingerprint"], r["edited_fingerprint"], *(round(r[c], 9) for c in names)) for r in got.collect()) == want
    only = fingerprints.fingerprints(df.where("doc_id is null"), scale=scale).collect()
    assert len(only) == 2 and all(r["near_next"] == 1 for r in only)


def test_sketches_merge_and_contain(spark):
    """The union of the parts' sketches is the whole's, and a hundredth of a text is found in it."""
    rnd = random.Random(5)
    words = [str(rnd.randrange(10 ** 6)) for _ in range(20000)]
    whole, part, rest = " ".join(words), " ".join(words[:204]), " ".join(words[200:])
    df = spark.createDataFrame([(whole, part, rest)], "whole string, part string, rest string")
    s = {c: fingerprints.sketch(fingerprints.shingles(df[c]), 8) for c in df.columns}
    r = df.select(fingerprints.merge(s["part"], s["rest"]).alias("m"), s["whole"].alias("w"), s["part"].alias("p"),
                  fingerprints.containment(s["part"], s["whole"], df["part"] == df["whole"]).alias("inside"),
                  fingerprints.parse(fingerprints.fingerprint_text(s["whole"], df["whole"])).alias("parsed")).first()
    assert r["m"] == r["w"] and r["p"] and r["inside"] == 1
    assert [int(x, 16) - (1 << 64) if int(x, 16) >> 63 else int(x, 16) for x in r["parsed"]] == r["w"]
    assert set(r["w"]) == retained(shingle_set(whole), 8)


def test_fingerprint_likeness_is_exact(spark):
    def of(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    rnd = random.Random(9)
    rows, text = [], ""
    for i in range(150):  # runs of near copies, most of them short
        words = text.split() if i % 3 and text else [f"w{rnd.randrange(90)}" for _ in range(rnd.choice([1, 4, 6, 9, 15, 30, 400]))]
        words[rnd.randrange(len(words))] = f"new{i}"
        text = " ".join(words)
        rows.append((i, text))
    rows.append((150, " \t "))
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        after = rows[i - 1][1]
        edited = t[:len(t) - len(t) // 3] + after[:len(t) // 3]
        for other, near, within in ((edited, "exact_near_edited", "exact_in_edited"), (after, "exact_near_next", "exact_in_next")):
            a, b = of(t), of(other)
            assert abs(got[i][near] - (1 if t == other else len(a & b) / max(1, len(a | b)))) < 1e-9, (i, near)
            assert abs(got[i][within] - (1 if t == other else len(a & b) / max(1, len(a)))) < 1e-9, (i, within)


def _frozen_tree(train, test, depth):
    """Plain recursion over dictionaries of nodes."""
    cnt, mem, kids = {}, {}, {}
    seq = lambda t: [255] * depth + list(t.lower()) + [255]
    for t in train:
        q = seq(t)
        for i in range(depth, len(q)):
            for d in range(depth + 1):
                z = 1
                for j in range(8):
                    bit = q[i] >> (7 - j) & 1
                    cnt.setdefault((tuple(q[i - k] for k in range(1, d + 1)), z), [0, 0])[bit] += 1
                    z = z * 2 + bit
    for c, z in cnt:
        if c:
            kids.setdefault((c[:-1], z), []).append((c, z))
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def mixed(n):
        if n not in mem:
            k = kt(*cnt[n])
            mem[n] = k if len(n[0]) == depth else np.logaddexp(k, sum(map(mixed, kids[n]))) - math.log(2)
        return mem[n]
    out = []
    for t in test:
        q, total = seq(t), 0.0
        for i in range(depth, len(q)):
            z = 1
            for j in range(8):
                bit, p = q[i] >> (7 - j) & 1, 0.5
                for d in range(depth, -1, -1):
                    n = (tuple(q[i - k] for k in range(1, d + 1)), z)
                    if n in cnt:
                        w = 1 if d == depth else 0.5 * math.exp(kt(*cnt[n]) - mixed(n))
                        p = w * (cnt[n][bit] + .5) / (sum(cnt[n]) + 1) + (1 - w) * p
                total += math.log10(p)
                z = z * 2 + bit
        out.append(total)
    return out


def test_scoring(spark):
    texts = ["The cat sat on the mat", "the hat é 日", "", None, "aaaa aaaa aaaa", "The cat sat on the hat", "b", "cat cat"] * 2
    rows = [*enumerate(texts), (None, "cat")]
    got = sorted(scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    raw = [(t or "").encode() for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    assert [r["held_out"] for r in got] == held
    assert np.allclose([r["score"] for r in got], _frozen_tree([x for x, h in zip(raw, held) if not h], raw, scoring.DEPTH), atol=1e-4)
    toks = [x.lower().split() + [None] for x in raw]
    c = collections.Counter(w for ws, h in zip(toks, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    for r, ws in zip(got, toks):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r["base_score"] - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) < 1e-9
    assert scoring.score(spark.createDataFrame(rows[:1], "doc_id long, text string").limit(0)).count() == 0


@pytest.mark.parametrize("chunk, block", [(2 << 20, 24 << 20), (300, 2000)])
def test_scoring_long_texts_and_other_columns(spark, monkeypatch, chunk, block):
    """Texts longer than a chunk, more blocks than one, and columns that share the operator's names change no score."""
    monkeypatch.setattr(scoring, "CHUNK", chunk)
    monkeypatch.setattr(scoring, "BLOCK_BYTES", block)
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcé", k=rnd.randrange(1, 7))) for _ in range(40)]
    rows = [(i, " ".join(rnd.choices(words, k=n))) for i, n in enumerate([3, 900, 0, 20, 5, 1200, 7, 60, 2, 300, 11, 1])]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    other = plain.selectExpr("*", "1 AS block", "'x' AS raw", "2 AS held_out", "'k' AS kind", "'b' AS bucket", "3.5 AS score", "'f' AS file", "7 AS row")
    got = [sorted(map(tuple, scoring.score(df).collect())) for df in (plain, other)]
    assert [r[:5] for r in got[0]] == [r[:5] for r in got[1]]
    assert np.allclose([r[5:] for r in got[0]], [r[5:] for r in got[1]], rtol=1e-6)
    raw = [t.encode() for _, t in rows]
    train = [x for (i, _), x in zip(rows, raw) if zlib.crc32(str(i).encode()) % 7 != 2]
    want = _frozen_tree(train, raw, scoring.DEPTH)
    assert np.allclose([r[6] for r in got[0]], want, rtol=1e-5, atol=1e-3)


def test_word_hashes_do_not_depend_on_place():
    a, b = shingles.Words([b"one two", b"", b" three  one\ttwo "]), shingles.Words([b"two one three"])
    assert a.hash[[0, 1, 2]].tolist() == b.hash[[1, 0, 2]].tolist() and a.hash[[3, 4]].tolist() == a.hash[[0, 1]].tolist()
    assert a.first.tolist() == [0, 2, 2, 5]


def test_encoder_remembers_a_large_vocabulary():
    """170,000 different words are encoded once each, however often they come back."""
    m = pieces.Merges(piece_model())
    words = ["".join(w) for w in itertools.islice(itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=4), 170_000)]
    text, calls, chunk = " ".join(words), [], m.chunk
    m.chunk = lambda c: calls.append(c) or chunk(c)
    first = m.packed(text)
    seen = len(calls)
    assert m.packed(text) == first and len(calls) == seen
