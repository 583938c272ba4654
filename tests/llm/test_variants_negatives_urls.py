"""Spelling variants, hard negatives and url rules: brute force and odd rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from flowguard.llm import negatives, spelling, urlrules


# ---- spelling variants

def edits(a, b):
    """Whether one insertion, deletion or replacement turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants_by_force(rows):
    total = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            total[w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w] += 1
    words = {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w)] for w in words}
    form = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in form.items() if words[v] >= 10 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def odd_texts():
    rnd = random.Random(3)
    stems = ["".join(rnd.choices("abcdeé", k=rnd.choice([6, 7, 8, 9, 12]))) for _ in range(40)]
    rows = [(0, None), (1, ""), (None, "Überall überall ÜBERALL"), (2, "×÷×÷×÷× ×÷×÷×÷× àÀàÀàÀà àÀàÀàÀà"), (3, "Q" * 70000 + " " + "q" * 70000 + " " + "q" * 70001),
            (4, "ﬁnally fin4lly finally_finally"), (5, "anagram nagaram anagrma anagram nagaram anagrma")]
    for k in range(60):
        words = []
        for s in rnd.choices(stems, k=60):
            if rnd.random() < 0.1:
                at = rnd.randrange(len(s))
                s = rnd.choice([s[:at] + s[at + 1:], s[:at] + rnd.choice("abé") + s[at:], s[:at] + rnd.choice("abé") + s[at + 1:]])
            words.append(s.upper() if rnd.random() < 0.1 else s)
        rows.append((k % 50, " ".join(words)))
    rows += [(7, "chainaa " * 2000 + "chainab " * 150 + "chainbb " * 12)] * 2  # repeated rows; a chain of forms
    return rows


@pytest.mark.parametrize("leaf, block", [(8192, 1 << 20), (16, 200)])
def test_variants_equal_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "BLOCK_BYTES", block)
    rows = odd_texts()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, word string, n int, leaf string")
    got = [tuple(r) for r in spelling.variants(df).collect()]
    assert len(got) == len(set(got)) and set(got) == variants_by_force(rows)
    assert any(r[1] and r[2] != r[1] for r in got)  # a root beyond the form
    assert spelling.variants(df.limit(0)).count() == 0 and spelling.variants(df.where("doc_id < 2 and text = ''")).count() == 0


def test_letter_vectors_never_add_distance():
    rnd = random.Random(1)
    for _ in range(300):
        w = "".join(rnd.choices("abcxyzàéÿ", k=rnd.randrange(7, 20)))
        at, c = rnd.randrange(len(w)), rnd.choice("abzàÿ")
        for v in (w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]):
            x = spelling.vectors([w, v]).astype(int)
            assert np.abs(x[0] - x[1]).sum() <= 2
            assert spelling.one_edit(spelling.grid([w]), spelling.grid([v]), np.array([0]), np.array([0]))[0] == (w != v and edits(w, v))
    assert (spelling.vectors(["a" * 900, "a" * 901]) <= 255).all()


def test_box_search_loses_nothing():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (400, spelling.DIMS)).astype(np.uint8)
    x[:, 6:] = 0
    code, cut = spelling.codes(x), np.minimum(x.astype(int), 2)
    assert (np.bitwise_count(code[:, None] ^ code) == np.abs(cut[:, None] - cut).sum(2)).all()
    low, high = cut[:300].reshape(60, 5, -1).min(1), cut[:300].reshape(60, 5, -1).max(1)
    for radius in (1, 2):
        d = np.maximum(np.maximum(low[None] - cut[:, None], cut[:, None] - high[None]), 0).sum(2)
        corners = (f.reduce(code[:300].reshape(60, 5), axis=1) for f in (np.bitwise_and, np.bitwise_or))
        i, j = spelling.reached(code, *corners, radius)
        assert len(i) == (d <= radius).sum() and set(zip(i.tolist(), j.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(d <= radius))))
    tree = spelling.Tree(x, 16)
    assert tree.leaves > 8 and set(tree.place(x)) == set(range(tree.leaves))


def test_pairs_within_boxes_equal_brute_force():
    rnd = random.Random(8)
    stems = ["".join(rnd.choices("abcdeé", k=9)) for _ in range(30)]
    words = sorted({s[:k] + rnd.choice("abcé") + s[k + 1:] for s in stems for k in range(9) for _ in range(3)})
    shorter = sorted({w[:k] + w[k + 1:] for w in words[::5] for k in (0, 4, 8)})
    boxes = spelling.Boxes(words)
    assert len(boxes.cut) > 4 * spelling.FAN and (boxes.size <= spelling.BUCKET).all() and sorted(boxes.row) == list(range(len(words)))
    for left in (words, shorter):
        got = list(zip(*map(np.ndarray.tolist, spelling.near(left, boxes))))
        assert len(got) == len(set(got)) > 100
        assert set(got) == {(i, j) for i, a in enumerate(left) for j, b in enumerate(words) if edits(a, b)}


def test_long_texts_go_in_slices(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 10)
    text = "abc Défghij, klmnopqrstuvwxyzabcdefgh x 12 yz" * 3
    assert list(spelling.runs(text)) == [w.lower() for w in re.findall(spelling.RUN, text)]


# ---- hard negatives

def negatives_by_force(rows):
    seen = {(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(v))) for v in e)) for i, e, label in rows
            if i is not None and label is not None and e is not None and all(v is not None and math.isfinite(v) for v in e)}
    out = set()
    for i, label, e in seen:
        if i % 100:
            continue
        scored = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(e, f)))), j, m) for j, m, f in seen if len(f) == len(e))
        for p, j, _ in [s for s in scored if s[2] == label and s[1] != i][:5]:
            fit = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out |= {(i, j, r, s[1], -p, -s[0]) for r, s in enumerate(fit, 1)}
    return out


def odd_vectors(n=900, dim=8):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(12, dim))
    rows = [(int(i), [float(v) for v in centre[i % 12] * rng.choice([0.2, 1, 3]) + rng.normal(size=dim) * 0.1], int(rng.integers(0, 4))) for i in range(n)]
    same = rows[8][1]
    rows += [(n + k, same, k % 3) for k in range(300)]  # ties
    rows += [(100, rows[100][1], rows[100][2])] * 3  # repeated rows
    rows += [(200, same, 1), (5000, [0.0] * dim, 1), (5001, [0.0] * dim, 2), (5100, [1.0] * 3, 1), (5101, [1.0, 0.5, 1.0], 1), (5102, [1.0, 0.5, 0.1], 2), (5200, [], 1),
             (5201, [], 1), (5202, [], 2), (5300, None, 1), (5400, [1.0] * dim, None), (None, [1.0] * dim, 1), (5500, [float("nan")] * dim, 1),
             (5600, [None] * dim, 2), (5700, [float("inf")] * dim, 1), (5800, [1e30] + [0.0] * (dim - 1), 1), (5801, [1e30] + [0.0] * (dim - 1), 1),
             (5802, [3e-15] + [0.0] * (dim - 1), 2), (5900, [-1.0] * dim, 77)]
    return rows


@pytest.mark.parametrize("head, members, block", [(4096, 256, 8192), (20, 3, 50)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, head, members, block):
    for name, value in (("HEAD", head), ("MEMBERS", members), ("BLOCK", block), ("MAX_CLUSTERS", 4 if members == 3 else 256)):
        monkeypatch.setattr(negatives, name, value)
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<float>, label int, x string, rank int")
    got = [tuple(r) for r in negatives.hard_negatives(df).collect()]
    want = negatives_by_force(rows)
    assert want and set(got) == want
    assert negatives.hard_negatives(df.limit(0)).count() == 0 and negatives.hard_negatives(df.where("vec_id = 1")).count() == 0


def test_bounds_are_upper_bounds():
    rng = np.random.default_rng(0)
    u, x = np.floor(rng.normal(size=(40, 6)) * 256), np.floor(rng.normal(size=(200, 6)) * 256)
    x[0] = 0
    c = u[:1] / np.linalg.norm(u[:1])
    size = np.linalg.norm(u, axis=1)
    spread = negatives._angles(u, size, c).max(0)
    b = negatives.bounds(x, c, spread)
    assert (u @ x.T <= size[:, None] * b[:, 0][None, :] * (1 + 1e-9) + 1e-6).all()
    near = np.abs(u @ c[0] / size) > np.cos(0.5)
    if near.any():  # a tight cluster's list falls
        tight = negatives.bounds(x, c, negatives._angles(u[near], size[near], c).max(0))
        assert (tight <= b + 1e-6).all()


# ---- url rules

RULES = [("com", "/", False), ("example.com", "/en/", True), ("www.example.com", "/en/", False), ("net", "/es/", True), ("net", "/fr/", True), ("same.org", "/a", True),
         ("same.org", "/a", False), (None, "/", True)]


def test_url_parts(spark):
    urls = {"http://A.Example.COM/En/x?q#f": ("a.example.com", "/En/x", "q"), "x://h": ("h", "", ""), "//h/p": ("", "", ""), None: ("", "", ""), "": ("", "", ""),
            "a://b://c/d": ("b:", "//c/d", ""), "s://h?x/y": ("h", "", "x/y"), "s://h#f?x": ("h", "", ""), "s:///p": ("", "/p", ""), "s://ÀB/": ("Àb", "/", ""),
            "s://u@h:80/p\n/q?z": ("u@h:80", "/p\n/q", "z")}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for r in df.select("url", *urlrules.url_parts(df["url"])).collect():
        assert tuple(r)[1:] == urls[r["url"]], r["url"]


def rules_by_force(labelled, support, confidence, lift, least, items):
    """Frequent combinations by enumeration, pruned as documented."""
    rows = [(sorted(t), bad) for t, bad in labelled if bad is not None]
    need = max(least, math.ceil(support * len(rows)))
    if len(rows) < need:
        return {}
    base = sum(b for _, b in rows) / len(rows)
    n, nb = Counter(t for ts, _ in rows for t in ts), Counter(t for ts, b in rows if b for t in ts)
    says = {t: abs(nb[t] / n[t] - base) * math.sqrt(n[t]) for t in n if n[t] >= need}
    count = Counter()
    for ts, b in rows:
        kept = sorted(sorted((t for t in ts if t in says), key=lambda t: (-says[t], t))[:items])
        for size in range(1, len(kept) + 1):
            for c in itertools.combinations(kept, size):
                count[c, None] += 1
                count[c, b] += 1
    sure = {(c, b): k / count[c, None] for (c, b), k in count.items() if b is not None and k >= need and k / count[c, None] >= confidence}
    return {(c, b): v for (c, b), v in sure.items() if v / (base if b else 1 - base) >= lift
            and not any(b == o and set(d) < set(c) and w >= v for (d, o), w in sure.items())}


def test_mined_rules_equal_enumeration(spark):
    rnd = random.Random(9)
    rows = []
    for k in range(400):
        host = rnd.choice(["casino-bets.example.net", "news.example.org", "blog.free-pills.example.com", "m.example.org"])
        url = f"https://{host}/{rnd.choice(['en', 'de'])}/{rnd.choice(['buy', 'read', 'faq'])}-{rnd.choice(['now', '17'])}{rnd.choice(['', '?ref=x', '?utm=1&ref=y'])}"
        bad = ("casino" in url and "buy" in url and rnd.random() < 0.95) or ("pills" in url and rnd.random() < 0.7) or rnd.random() < 0.05
        rows.append((url if k % 40 else None, None if k % 37 == 0 else bool(bad)))
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "url string, bad boolean, tokens string, row int")
    text = df.select("bad", urlrules.url_tokens(*urlrules.url_parts(df["url"])).alias("t")).collect()
    want = rules_by_force([(r["t"], r["bad"]) for r in text], 0.01, 0.6, 1.05, 10, 8)
    rules = urlrules.mine_rules(df, support=0.01)
    got = {(tuple(r["tokens"]), r["block"]): r["confidence"] for r in rules.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    assert any(b for _, b in got) and any(len(c) > 1 for c, _ in got)
    n = Counter(t for r in text if r["bad"] is not None for t in r["t"])
    for r in rules.collect():
        assert r["post"] == min(r["tokens"], key=lambda t: (n[t], t))
    # verdicts: the longest listed rule, else the surest mined rule, else allow
    pages = spark.createDataFrame([(k % 300, u, "h", "r") for k, (u, _) in enumerate(rows)] + [
        (None, "http://www.example.com/en/1", "h", "r"), (1000, "http://a.www.example.com/en/", "h", "r"), (1001, "http://example.com/en/?x", "h", "r"),
        (1002, "http://x.com", "h", "r"), (1003, "http://notexample.com/en/", "h", "r"), (1004, "ftp://same.org/abc", "h", "r"), (1005, None, "h", "r"),
        (1006, "http://net/fr/" + "x" * 100000, "h", "r"), (1007, "http://" + "a." * 3000 + "net/es/", "h", "r"), (1008, "http://net./es/", "h", "r")],
        "page_id long, url string, host string, rule string")
    listed = spark.createDataFrame(RULES, "host string, path string, block boolean")
    out = urlrules.judge(pages, listed, df, support=0.01)
    assert out.count() == pages.count()
    tokens = {r["url"]: set(r["t"]) for r in pages.select("url", urlrules.url_tokens(*urlrules.url_parts(pages["url"])).alias("t")).collect()}
    full = {k: (v, s) for k, v in want.items() for s in [sum(r["bad"] == k[1] and set(k[0]) <= set(r["t"]) for r in text)]}
    expect = Counter()
    for r in pages.collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r["url"] or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), len(h), b, h + p) for h, p, b in RULES if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        fired = [(v, s, len(c), b) for (c, b), (v, s) in full.items() if set(c) <= tokens[r["url"]]]
        block = max(fits)[2] if fits else max(fired)[3] if fired else False
        expect[r["page_id"], host, path, max(fits)[3] if fits else None, "block" if block else "allow"] += 1
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()) == expect
    assert urlrules.judge(pages.limit(0), listed, df).count() == 0
    none = urlrules.judge(pages, listed.limit(0), df.limit(0))
    assert {(r["rule"], r["verdict"], r["because"]) for r in none.collect()} == {(None, "allow", None)}


def test_all_frequent_tokens_are_mined(spark):
    """The query's mining leaves out no frequent token: rules lie beyond the eight that say most, and tokens of the same rows keep all of theirs."""
    rnd, rows = random.Random(4), []
    for k in range(300):
        bad = rnd.random() < 0.5
        strong = "&".join(f"s{i}=1" for i in range(8) if rnd.random() < (0.72 if bad else 0.28))
        pair = [rnd.random() < 0.5 for _ in range(2)]
        bad = bad if pair[0] == pair[1] else pair[0]  # two weak tokens that decide only together
        rows.append(("http://h.org/" + "/".join(["twin/same"] * (k % 3 == 0) + ["one"] * pair[0] + ["two"] * pair[1]) + "?" + strong, bad))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    text = [(r["t"], r["bad"]) for r in df.select("bad", urlrules.url_tokens(*urlrules.url_parts(df["url"])).alias("t")).collect()]
    want = rules_by_force(text, 0.15, 0.6, 1.05, 10, 99)
    assert set(want) != set(rules_by_force(text, 0.15, 0.6, 1.05, 10, 8))
    rules = urlrules.mine_rules(df, support=0.15, items=None)
    got = {(tuple(r["tokens"]), r["block"]): r["confidence"] for r in rules.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    n = Counter(t for ts, _ in text for t in ts)
    assert all(r["post"] == min(r["tokens"], key=lambda t: (n[t], t)) for r in rules.collect())
    assert {"path:twin", "path:same"} & {t for c, _ in want for t in c} in (set(), {"path:twin", "path:same"})


def test_op13_mines_all_tokens(spark, monkeypatch, tmp_path):
    """The query asks for all tokens."""
    from flowguard.llm import catalog

    spark.createDataFrame([(k, f"http://h{k % 3}.org/p") for k in range(9)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(k, k % 2, 0) for k in range(9)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    asked, mine = [], urlrules.mine_rules
    monkeypatch.setattr(urlrules, "mine_rules", lambda labelled, **mining: asked.append(mining) or mine(labelled, **mining))
    assert catalog.op13_url_rules(spark, str(tmp_path)).count() == 9 and asked == [{"items": None}]


def test_url_filter_is_native(spark, monkeypatch):
    df = spark.createDataFrame([(k, f"http://h{k % 3}.org/p", k % 3 == 0) for k in range(60)], "page_id long, url string, bad boolean")
    df.write.mode("overwrite").parquet(path := spark.sparkContext.getCheckpointDir() + "/native-urls")
    pages = spark.read.parquet(path)
    plan = urlrules.judge(pages, pages.select(pages["url"].alias("host"), pages["url"].alias("path"), "bad").toDF("host", "path", "block"), pages)
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", text)
