"""WARC, chat windows, mixing, near duplicates and the pipeline: brute force and odd rows."""

import collections
import gzip
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from flowguard.llm import chat, embeddings, mixing, neardup, shingles, warc


def test_warc(spark):
    big = "é\r\nWARC/1.1\r\n" + "x<p>日本</p>" * 30000
    rows = [(0, "u", big, "k"), (1, None, big, "k"), (2, "u\nv", None, "k"), (3, "u", "", "k"), (4, "u", "x" * 999, "k"), (5, "u", "x" * 999, "k"),
            (6, "u", "x" * 1000, "k"), (7, "u", "x" * 1000, "k"), (8, "u", "\r\n\r\n", "k"), (9, "u", "y" * 70000, "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, status string")
    got = {r["page_id"]: r for r in warc.archive_pages(df, segment=20000).collect()}
    for i, _, html, _ in rows:
        body = (html or "").encode()
        last = max(j for j, _, h, _ in rows if (h or "").encode() == body)
        want = ("response", None) if len(body) < 1000 or last == i else ("revisit", last)
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["status"]) == (len(body), hashlib.sha1(body).hexdigest(), *want, "ok")
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_warc_null_and_repeated_ids(spark):
    """Rows of null or equal page_id are records of their own."""
    big, other = "a" * 100000, "b" * 100000
    rows = [(None, "u", big), (None, "u", None), (None, None, "x"), (5, "u", big), (5, "u", other), (5, "u", "small"), (5, "u", "small"),
            (6, "u", other), (6, "u", other), (7, "u", "c" * 150000), (7, "u", "c" * 150000), (-3, "u", "neg")]
    df = spark.createDataFrame([(*r, "n", "r") for r in rows], "page_id long, url string, html string, name string, record_id string")
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["status"])
                              for r in warc.archive_pages(df, segment=20000).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = collections.Counter([
        (None, 100000, sha(big), "revisit", 5, "ok"), (None, 0, sha(""), "response", None, "ok"), (None, 1, sha("x"), "response", None, "ok"),
        (5, 100000, sha(big), "response", None, "ok"), (5, 100000, sha(other), "revisit", 6, "ok"), (5, 5, sha("small"), "response", None, "ok"),
        (5, 5, sha("small"), "response", None, "ok"), (6, 100000, sha(other), "revisit", 6, "ok"), (6, 100000, sha(other), "response", None, "ok"),
        (7, 150000, sha("c" * 150000), "revisit", 7, "ok"), (7, 150000, sha("c" * 150000), "response", None, "ok"), (-3, 3, sha("neg"), "response", None, "ok")])
    assert got == want


def test_warc_segments(spark, tmpdir_path):
    """Missing, doubled, altered and misnumbered segments are reported, not guessed; the order of records is free."""
    body = bytes(range(256)) * 40
    cases = {"ok": lambda r: r, "shuffled": lambda r: r[::-1], "missing": lambda r: r[:1] + r[2:], "no last": lambda r: r[:-1], "no first": lambda r: r[1:],
             "doubled": lambda r: r + r[1:2], "altered": lambda r: r + [r[1].replace(bytes(range(60, 80)), bytes(20))],
             "total": lambda r: [x.replace(b"Total-Length: ", b"Total-Length: 1") for x in r],
             "digest": lambda r: [r[0].replace(b"Payload-Digest: sha1:", b"Payload-Digest: sha1:0")] + r[1:],
             "framing": lambda r: [x.replace(b"\r\n2800\r\n", b"\r\n27ff\r\n") for x in r]}
    records = [x for name, change in cases.items() for x in change(list(warc.page_records(name, "u", body, 2000)))]
    records += [warc._record("warcinfo", "<urn:info>", b"about"), warc._record("revisit", "<urn:page:r>", b"", WARC_Refers_To="<urn:page:gone>")]
    with gzip.open(f"{tmpdir_path}/part-0.warc.gz", "wb") as f:
        f.write(b"\r\n\r\n".join(records[:30]) + b"\r\n\r\n")
    with gzip.open(f"{tmpdir_path}/part-1.warc.gz", "wb") as f:
        for r in records[30:]:
            f.write(r + b"\r\n\r\n")
    want = {n: "broken" if n in ("missing", "no last", "no first", "doubled", "altered", "total", "framing") else "digest differs" if n == "digest" else "ok" for n in cases} | {"r": "ok"}
    for payloads in (True, False):
        got = {r["record_id"][10:-1]: r for r in warc.read_archives(spark, tmpdir_path, payloads).collect()}
        assert {n: r["status"] for n, r in got.items()} == want
        assert all((bytes(got[n]["payload"]) == body if payloads else got[n]["payload"] is None) and got[n]["payload_bytes"] == len(body)
                   for n in ("ok", "shuffled", "digest"))
        assert all(got[n]["payload_digest"] is None and got[n]["payload"] is None for n in want if want[n] == "broken")
    assert warc.page_digests(spark, tmpdir_path).where("record_type = 'revisit'").first()["status"] == "unresolved"


def test_unframed_rejects_broken_framing():
    good = warc.framed(b"abc" * 9000)
    assert warc.unframed(good) == b"abc" * 9000 and warc.unframed(good[:-100]) is None and warc.unframed(b"no head") is None


@pytest.mark.parametrize("budget, history", [(1024, 256), (12, 6), (1, 0)])
def test_chat(spark, budget, history):
    rows = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"), (1, 0, "assistant", None),
            (1, 1, None, "x\n</turn>\n### user: \\"), (1, 1, "a:b\\", "<"), (1, 2, "assistant", "<"), (1, 2, "assistant", "<"), (1, 3, "system", "big " * 3000),
            (2, 0, "system", "be brief"), *((2, k, ("user", "assistant")[k % 2], f"turn {k} says é") for k in range(1, 20)), (None, None, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(df, budget, history)
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.read_windows(windows)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1), r or "", x or "") for c, t, r, x in rows if c == conv)
        said, loss = "".join(f"{r}\n{x}\n" for _, r, x in turns), "".join(x for _, r, x in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for w in windows.collect():
        new = w["text"].count("</turn>\n") - w["n_context"]
        assert new >= 1 and (w["n_words"] <= budget or new == 1)
        assert w["conv_id"] != 2 or "be brief" in w["text"]
    assert chat.format_windows(df.limit(0)).count() == 0


def test_chat_ignores_other_columns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a </turn>\n b"), (2, 0, "assistant", None), (None, None, None, "x")]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    names = list(dict.fromkeys([*chat.format_windows(plain).columns, "n_turns", "words", "n", "start", "escaped", "formatted_chars"]))
    other = plain.selectExpr("*", *(f"'clash' AS `{c}`" for c in names if c not in plain.columns))
    out = []
    for df in (plain, other):
        windows = chat.format_windows(df, 12, 4)
        out.append((sorted(map(repr, windows.collect())), sorted(map(repr, chat.conversation_digests(chat.read_windows(windows)).collect()))))
    assert out[0] == out[1] and len(out[0][1]) == 3


@pytest.mark.parametrize("budget, history", [(60, 20), (25, 9)])
def test_chat_windows_of_a_long_conversation(spark, budget, history):
    """Windows are those of the greedy rule, and no step of the plan collects a conversation."""
    rnd = random.Random(11)
    rows = [(c, k, "system" if k == 0 and c != 1 else rnd.choice(["user", "assistant"]), "w " * rnd.choice([0, 1, 4, 9, 30])) for c, n in ((1, 300), (None, 90), (3, 1)) for k in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(df, budget, history)
    got = {(r["conv_id"], r["window"]): r for r in windows.collect()}
    want = {}
    for conv in (1, None, 3):
        ts = [(r, len(x.split()) + chat.MARKS, f"### {r}: {x}</turn>\n", len(f"### {r}: "), len(x)) for c, _, r, x in rows if c == conv]
        before = [sum(t[1] for t in ts[:k]) for k in range(len(ts) + 1)]
        keep = int(ts[0][0] == "system")
        mine = [(0, 0)]
        for k in range(1, len(ts)):
            s, h = mine[-1]
            if before[k + 1] - before[h] + (keep * ts[0][1] if s else 0) > budget:
                least = max(before[k] - history, before[k + 1] + keep * ts[0][1] - budget)
                mine.append((k, max(keep, min(k, sum(b < least for b in before[:-1])))))
        for i, (s, h) in enumerate(mine):
            e = mine[i + 1][0] if i + 1 < len(mine) else len(ts)
            part = ([0] if s and keep else []) + list(range(h, e))
            lens = np.cumsum([0] + [len(ts[k][2]) for k in part])
            mask = [(int(lens[j]) + ts[k][3], ts[k][4]) for j, k in enumerate(part) if k >= s and ts[k][0] == "assistant"]
            want[conv, i] = ("".join(ts[k][2] for k in part), len(part) - (e - s), mask, before[e] - before[h])
    assert {k: (r["text"], r["n_context"], [tuple(m) for m in r["mask"]], r["n_words"]) for k, r in got.items()} == want
    plan = windows._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[conv_id#\d+L?\],", plan) and len(got) > 9


def test_fit_counts_is_exact_where_it_can_be():
    rnd = random.Random(4)
    for _ in range(200):
        sizes = np.array(rnd.sample(range(0, 30), rnd.randint(1, 6)))
        counts = np.array([rnd.randint(1, 4) for _ in sizes])
        budget = rnd.randint(0, int((sizes * counts).sum()))
        got = mixing.fit_counts(sizes, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        words = int((got * sizes).sum())
        even = [int(c) * budget // max(1, int((sizes * counts).sum())) for c in counts]  # the even share is always taken
        best = max((s for s in (sum(k * z for k, z in zip(ks, sizes)) for ks in itertools.product(*(range(e, c + 1) for e, c in zip(even, counts)))) if s <= budget))
        assert words == best


def _targets(sizes, weights, wanted):
    """The contract's rounds: share by weight, cap, reshare the excess."""
    target, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = wanted
    while free and left > 1e-9:
        total = sum(weights[i] for i in free)
        give = {i: left * weights[i] / total for i in free}
        left = 0.0
        for i, g in give.items():
            target[i] += g
            if target[i] >= 2 * sizes[i]:
                left += target[i] - 2 * sizes[i]
                target[i] = 2 * sizes[i]
                free.discard(i)
    return target


def test_mixing(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.choice([0, 1, 5, 17, 200]), rnd.choice(["é", "a", "b", None, "a", "a"]), "x") for i in range(300)]
    rows += [(1000 + i, "same text here", "hot", "x") for i in range(200)] + [(1, "again", "a", "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(3)).collect()
    assert len(got) == len(rows) and sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    names = sorted({r[2] for r in rows if r[2]}) + [None]
    sizes = [sum(len(t.split()) for _, t, s, _ in rows if s == n) for n in names]
    want = _targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(sizes))
    for n, size, target in zip(names, sizes, want):
        mine = [r for r in got if r["source"] == n]
        assert all(r["source_size"] == size and abs(r["target"] - target) < 1e-6 for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= 5 and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in mine)
    assert mixing.mix(df.limit(0)).count() == 0


def _classes(rows, like):
    """Union-find over all pairs."""
    root, n = {i: i for i, _ in rows}, [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in itertools.combinations(range(len(rows)), 2):
        if like(rows[a][1], rows[b][1]):
            n[a], n[b] = n[a] + 1, n[b] + 1
            x, y = sorted((find(rows[a][0]), find(rows[b][0])))
            root[y] = x
    return {(i, find(i), k) for (i, _), k in zip(rows, n)}


def _jaccard(a, b):
    sets = []
    for t in (a, b):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    both = len(sets[0] & sets[1])
    return both > 0 and both >= 0.8 * len(sets[0] | sets[1]) - 1e-9


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates(spark, block):
    rnd = random.Random(6)
    base = [[f"w{rnd.randrange(900)}" for _ in range(120)] for _ in range(6)]
    rows = []
    for i in range(90):
        words = list(base[i % 6])
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            words[rnd.randrange(120)] = f"new{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    rows += [(200, ""), (201, None), (202, "short text"), (203, "short  text"), (204, "short text")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_links int")
    got = neardup.near_duplicates(df, block=block).collect()
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in got} == _classes(rows, _jaccard) and len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    twice = neardup.near_duplicates(df.unionByName(df)).where("doc_id = 202").collect()
    assert [(r["class_id"], r["n_links"]) for r in twice] == [(202, 5)] * 2
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_posterior_cut_keeps_pairs_at_the_threshold():
    for n, least in neardup.least_matches(0.8, neardup.TOLERANCE, 150, 30):
        assert 0 < least < 0.8 * n


def test_near_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 16))
    x = np.repeat(base, 5, 0) + rng.normal(size=(200, 16)) * rng.choice([0, 0.05, 0.3], 200)[:, None]
    x = x.astype(np.float32)
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [1.0, 2.0], [2.0, 4.0], [float("inf")] + [1.0] * 15]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(1000 + i, v, 0) for i, v in enumerate(odd)]
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    links = u @ u.T >= 0.95
    np.fill_diagonal(links, False)
    found = np.array([got[i]["n_links"] for i in range(200)])
    assert (found <= links.sum(1)).all() and found.sum() >= 0.9 * links.sum()
    assert got[1005]["n_links"] == 1 and got[1006]["component_id"] == 1005 and not got[1006]["kept"]
    assert all(got[1000 + k]["n_links"] == 0 and got[1000 + k]["kept"] for k in (0, 1, 2, 3, 4, 7))


def test_weak_collisions_tie_nothing(spark, monkeypatch):
    """A chain of 5,000 texts that share a band each with the next, but nothing else: no part, and few pairs compared."""
    seen = spark.sparkContext.accumulator(0)
    rng = np.random.default_rng(5)
    rows = [(i, [10 * i, 10 * i + 10], rng.integers(0, 256, neardup.ROWS * neardup.BANDS).astype(np.uint8).tobytes()) for i in range(5000)]
    near = bytearray(rows[7][2])
    near[3] ^= 1
    rows[8] = (8, rows[8][1], bytes(near))
    df = spark.createDataFrame([(i, b, bytearray(s)) for i, b, s in rows], "id long, bands array<long>, sig binary")
    alike = neardup.alike

    def counted(a, b, steps):
        seen.add(len(a) * len(b))
        return alike(a, b, steps)
    monkeypatch.setattr(neardup, "alike", counted)
    assert {tuple(r) for r in neardup.candidate_parts(df, 0.8).collect()} == {(7, 7), (8, 7)}
    assert alike is not counted


def test_tied_parts_are_connected_candidates():
    """The search in breadth finds the same parts as all pairs do."""
    rng = np.random.default_rng(9)
    steps = neardup.least_matches(0.8, neardup.TOLERANCE, 150, 30)
    base = rng.integers(0, 256, (25, 150)).astype(np.uint8)
    sig = base[rng.integers(0, 25, 160)]
    change = rng.random(sig.shape) < rng.choice([0, 0.1, 0.2, 0.3], 160)[:, None]
    sig = np.where(change, rng.integers(0, 256, sig.shape), sig).astype(np.uint8)
    ids = rng.permutation(1000)[:160].astype(np.int64)
    pairs = []
    for i in range(160):
        for j in range(i):
            same = sig[i] == sig[j]
            if all(same[:n].sum() >= least for n, least in steps):
                pairs.append((ids[i], ids[j]))
    want = dict(zip(*map(np.ndarray.tolist, shingles.star(*map(np.array, zip(*pairs))))))
    u, v = neardup.tied(ids, sig, steps)
    assert dict(zip(u.tolist(), v.tolist())) == want and len(want) > 50
    work = []
    real = neardup.alike
    try:
        neardup.alike = lambda a, b, s: work.append(len(a) * len(b)) or real(a, b, s)
        neardup.tied(np.arange(3000), np.repeat(base[:1], 3000, 0), steps)
    finally:
        neardup.alike = real
    assert sum(work) < 3 * 3000  # near copies take a comparison each, not one for each pair


def test_large_buckets_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET_BLOCK", 5)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (2, 150)).astype(np.uint8)
    rows = [(i, [1, 2 + i % 2], bytearray(base[i % 2].tobytes())) for i in range(40)]
    got = neardup.candidate_parts(spark.createDataFrame(rows, "id long, bands array<long>, sig binary"), 0.8)
    assert {tuple(r) for r in got.collect()} == {(i, i % 2) for i in range(40)}


def test_near_duplicates_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(None, text), (3, text), (None, text + " end"), (4, text + " end"), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"], r["kept"]) for r in neardup.near_duplicates(df).collect()), key=str)
    assert got == [(3, 3, 1, True), (4, 3, 1, False), (None, None, 0, True), (None, None, 0, True), (None, None, 0, True)]


def test_near_vectors_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, component_id int"
    rows = [(1, [1.0, 0.0], 9), (1, [1.0, 0.0], 9), (2, [1.0, 0.01], 9), (None, [1.0, 0.0], 9), (3, [0.0, 1.0], 9), (3, [5.0, 0.0], 9)]
    got = collections.Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_vectors(spark.createDataFrame(rows, schema)).collect())
    # rows count by themselves, also where they share an id; a row without an id links with nothing
    assert got == collections.Counter([(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (3, 3, 1, False), (None, 0, None, True)])
    assert embeddings.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_near_vector_recall_at_20000(spark):
    """10,000 planted pairs at cosine 0.95 and more among 20,000 vectors: at least nine tenths are found, none false."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(10000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    c = rng.uniform(0.951, 0.97, (10000, 1))
    y = c * x + np.sqrt(1 - c * c) * away
    v = np.concatenate([x, y]).astype(np.float32)
    df = spark.createDataFrame([(i, r) for i, r in enumerate(v.tolist())], "vec_id long, embedding array<float>")
    got = embeddings.near_vectors(df).where("n_links > 0").select("vec_id", "component_id", "n_links").toPandas()
    assert (got["n_links"] == 1).all() and (got["component_id"] == got["vec_id"] % 10000).all()
    assert len(got) >= 0.9 * 20000


def test_near_vector_query_equals_its_sql_where_there_are_links(spark, tmp_path):
    """The query and its SQL on a table with copies, near copies, chains whose ends do not link, and odd rows."""
    import duckdb

    from flowguard.llm import catalog
    rng = np.random.default_rng(21)
    base = rng.normal(size=(150, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    rows = []
    for i in range(150):
        turns = [0] if i % 3 else [0, 0, 0.05, 0.21, 0.42]  # cosines of a chain's neighbours 0.978, of its ends 0.913
        rows += [(np.cos(t) * base[i] + np.sin(t) * away[i]).astype(np.float32).tolist() for t in turns]
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] * 24, [1.0, 2.0], [2.0, 4.0]]
    order = rng.permutation(len(rows))
    df = spark.createDataFrame([(int(k), rows[j], 0) for k, j in enumerate(order)], "vec_id long, embedding array<float>, label int")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {tuple(r) for r in catalog.queries()["op8_embedding_neardup"](spark, str(tmp_path)).select("vec_id", "n_links", "component_id", "kept").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = set(con.sql(f"SELECT vec_id, n_links, component_id, kept FROM ({catalog.oracle_sql()['op8_embedding_neardup']})").fetchall())
    assert got == want and sum(r[1] for r in want) > 500 and len({r[2] for r in want}) < len(rows) - 190


def test_probes_reach_pairs_at_4096_lists():
    """Pairs outside the sample that the index was fitted on, with as many lists as there can be."""
    rng = np.random.default_rng(12)
    index = embeddings.Index(embeddings._unit(rng.normal(size=(embeddings.SAMPLE, 64))), embeddings.MAX_LISTS)
    x = embeddings._unit(rng.normal(size=(2000, 64)))
    away = rng.normal(size=x.shape)
    away = embeddings._unit(away - (away * x).sum(1, keepdims=True) * x)
    y = 0.955 * x + np.sqrt(1 - 0.955 ** 2) * away
    home_x, home_y = index.probe(x)[:, 0], index.probe(y)[:, 0]
    met = (index.probe(x) == home_y[:, None]).any(1) | (index.probe(y) == home_x[:, None]).any(1)
    assert len(index.centroids) == 4096 and met.mean() >= 0.95


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as p

    rnd = random.Random(8)
    words = "the of and to in is that for with are this was".split()
    docs = [(i, " ".join(rnd.choice(words) for _ in range(40)), "en", f"s{i % 3}", 0) for i in range(40)]
    docs += [(100, docs[0][1], "en", "s0", 0), (101, None, "en", "s0", 0), (102, "12 34", "en", None, 0), docs[1]]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = p.language_id(spark, df, str(tmp_path))
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {*range(40), 100}
    kept = p.near_duplicates(spark, p.quality_classifier(spark, kept, str(tmp_path)), str(tmp_path))
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    out = p.run(spark, str(tmp_path)).collect()
    assert abs(sum(r["doc_id"] is not None for r in out) - 60) <= 2 and all(r["round_trip"] for r in out)


def test_pipeline_keeps_distinct_texts_of_one_id(spark, tmp_path):
    import corpus_pipeline as p

    rnd = random.Random(10)
    text = [" ".join(f"w{rnd.randrange(900)}" for _ in range(100)) for _ in range(9)]
    near = text[2] + " end"
    rows = [(3, text[0]), (5, text[0]), (5, text[1]), (2, text[2]), (7, near), (7, text[3]), (8, text[4]), (8, text[5]), (8, text[5]),
            (None, text[6]), (None, text[6]), (None, text[2]), (None, text[7]), (None, text[7] + " end"), (9, text[8]), (None, None), (None, None)]
    df = spark.createDataFrame([(*r, "en", "s", k) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = p.near_duplicates(spark, df, str(tmp_path))
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    seven = next(t for i, t in got if i is None and t in (text[7], text[7] + " end"))  # of null ids the digest decides
    want = [(3, text[0]), (5, text[1]), (2, text[2]), (7, text[3]), (8, text[4]), (8, text[5]), (9, text[8]), (None, text[6]), (None, seven), (None, None)]
    assert kept.columns == df.columns and sorted(got, key=str) == sorted(want, key=str)


def test_pipeline_judges_quality_row_by_row(spark, tmp_path):
    """A bad row goes and a good one stays, whatever else shares their doc_id, or where they have none."""
    import corpus_pipeline as p

    rnd = random.Random(14)
    good = lambda: " ".join(rnd.choice("alpha beta gamma delta words go on here".split()) for _ in range(60)) + "."
    bad = lambda: " ".join(rnd.choice("ALPHA!! BETA!! GAMMA!! GO!!".split()) for _ in range(60))
    rows = [(i, good() if i < 60 else bad(), "en", f"s{i % 3}", 0) for i in range(120)]
    odd = [(7, bad(), "en", "s1", 1), (7, good(), "en", "s1", 2), (None, bad(), "en", "s1", 3), (None, good(), None, None, 4), (None, None, "en", "s1", 5)]
    df = spark.createDataFrame(rows + odd + odd[:2], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = p.quality_classifier(spark, df, str(tmp_path))
    got = kept.collect()
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in got if r["n_chars"] == 0) == list(range(60))
    assert collections.Counter(r["n_chars"] for r in got if r["n_chars"]) - collections.Counter({5: 1}) == collections.Counter({2: 2, 4: 1})
