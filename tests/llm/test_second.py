"""Scoring, chat, near copies, embeddings, quality and the pipeline against brute force on small tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from brieflight.llm import chat, common, embeddings, hmm, minhash, quality


def components(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(40)]
    got = dict(tuple(x) for x in common.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect())
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == components(nodes, pairs)
    for seed in range(3):  # long chains and trees, in any order of names
        r = random.Random(seed)
        names = r.sample(range(10_000), 90)
        pairs = [(names[i], names[r.randrange(i)] if i % 30 else names[i]) for i in range(1, 90)] + [(names[i], names[i + 1]) for i in range(0, 25)]
        nodes = {x for p in pairs if p[0] != p[1] for x in p}
        rows = common.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
        assert len(rows) == len(nodes) and dict(map(tuple, rows)) == components(nodes, [p for p in pairs if p[0] != p[1]])
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# near copies


def shingles(text, k):
    w = [x for x in (text or "").encode().lower().split()]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_near_copies(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    rows = [(1, None), (2, ""), (3, " \t "), (4, "one two"), (5, "One  TWO"), (6, "one"), (7, "one two three"), (8, "one"), (8, "one"), (None, "one two")]
    i = 100
    for _ in range(8):
        base = [word() for _ in range(r.choice([40, 90, 300]))]
        for _ in range(r.choice([1, 6, 25])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
                copy[r.randrange(len(copy))] = word()
            rows.append((i, " ".join(copy)))
            i += 1
    docs = spark.createDataFrame([(a, t, 0) for a, t in rows], "doc_id long, text string, kept int")
    for words, percent in ((3, 85), (5, 80)):
        sets = {a: shingles(t, words) for a, t in rows if a is not None}
        ids = sorted(sets)
        pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        want = components(ids, pairs)
        got = minhash.components(docs, words, percent).collect()
        assert len(got) == len(rows)
        for x in got:
            if x.doc_id is None:
                assert x.component_id is None and x.kept and x.n_shingles == len(shingles("one two", words))
            else:
                assert (x.component_id, x.kept, x.n_shingles) == (want[x.doc_id], want[x.doc_id] == x.doc_id, len(sets[x.doc_id])), x
    left = minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in left.collect()) == sorted([(False, a) for a in ids if want[a] == a] + [(True, 0)])
    assert minhash.components(docs.where("doc_id < 0")).count() == 0


def test_rows_that_repeat_a_doc_id_with_other_texts(spark, monkeypatch):
    """No link is lost, one doc_id has one component, and a text without a copy stays."""
    x, y, z = ("".join(f"{c}{i} " for i in range(40)) for c in "xyz")
    rows = [(3, x), (5, x), (5, y), (7, y), (8, z), (8, None), (9, z + "more"), (9, z + "more"), (None, x), (11, None), (11, "")]
    docs = spark.createDataFrame([(*r, "k", "m") for r in rows], "doc_id long, text string, __gone string, d string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.components(docs).collect())
    assert got == sorted([(False, 3, 3, True), (False, 5, 3, False), (False, 5, 3, False), (False, 7, 3, False), (False, 8, 8, True), (False, 8, 8, True), (False, 9, 8, False), (False, 9, 8, False), (True, 0, 0, True), (False, 11, 11, True), (False, 11, 11, True)])
    left = minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    want = [(3, x), (5, y), (8, z), (8, None), (None, x), (11, None), (11, "")]
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted((i or 0, t or "") for i, t in want)
    twice = spark.createDataFrame([(1, x), (1, x), (2, x)], "doc_id long, text string")
    assert [tuple(r) for r in minhash.drop_near_copies(twice).collect()] == [(1, x)]


def test_a_large_group_is_dealt_out(spark, monkeypatch):
    """One text and many near copies of it, in cells of four."""
    monkeypatch.setattr(minhash, "CELL", 4)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    r = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(r.choice([1, 2, 4, 6])):
            copy[r.randrange(100)] = f"v{r.random()}"
        rows.append((i, " ".join(copy)))
    sets = {i: shingles(t, 5) for i, t in rows}
    want = components(sets, [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    got = {x.doc_id: x.component_id for x in minhash.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_few_edges_are_joined_without_rounds(spark, monkeypatch):
    """The driver and the rounds give the same components; few edges are written once, not once a round."""
    r = random.Random(21)
    pairs = [(r.randrange(-200, 200), r.randrange(-200, 200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)]
    edges, written, write = spark.createDataFrame(pairs, "a long, b long"), [], common.saved
    monkeypatch.setattr(common, "saved", lambda df, name: written.append(name) or write(df, name))
    few = sorted(map(tuple, common.connected_components(edges).collect()))
    assert len(written) == 1
    monkeypatch.setattr(common, "FEW", 0)
    assert few == sorted(map(tuple, common.connected_components(edges).collect()))


def test_sieve_loses_no_id(spark, monkeypatch):
    ids = spark.range(0, 30000, 3).withColumnRenamed("id", "x")
    rows = spark.range(30000).unionAll(spark.sql("select cast(null as long)"))
    for bits in (1 << 26, 1 << 13):  # with room, and with more ids than bits
        monkeypatch.setattr(common, "SIEVE", bits)
        passed = common.sieve(ids)
        got = rows.select("id", passed("id").alias("p"), (~passed("id")).alias("q")).collect()
        assert all(x.p for x in got if x.id is not None and x.id % 3 == 0)
        assert all(x.p is not None and x.p != x.q for x in got)
        if bits == 1 << 26:
            assert sum(x.p for x in got) < 10000 + 0.1 * 20000
    assert not any(x[0] for x in rows.select(common.sieve(ids.where("x < 0"))("id")).collect())


def test_sieve_runs_no_python(spark):
    """A Python function in the filter would give every task that also runs mapInArrow a second Python worker."""
    docs = spark.createDataFrame([(i, f"word{i} of a text") for i in range(20)], "doc_id long, text string")
    for left in (docs.where(common.sieve(spark.range(5))("doc_id")), minhash.drop_near_copies(docs)):
        left.collect()
        assert "EvalPython" not in left._jdf.queryExecution().toString()


def test_texts_are_not_moved_for_what_few_of_them_need(spark, monkeypatch):
    """Copies among many other texts: sets are made, and copies dropped, without a join that moves the other texts."""
    plans, write = {}, minhash.saved
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(minhash, "saved", lambda df, name: plans.setdefault(name, plan(df)) and write(df, name))
    texts = [" ".join(f"w{i}-{j}" for j in range(30)) for i in range(200)]
    docs = spark.createDataFrame([*enumerate(texts), (500, texts[7]), (501, texts[8] + " more"), (9, texts[9]), (None, texts[3])], "doc_id long, text string")
    left = minhash.drop_near_copies(docs)
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in left.collect()) == [*((False, i) for i in range(200)), (True, 0)]
    assert "LeftSemi" not in plans["minhash-sets"]
    top = plan(left).split("\n")
    assert top[0].startswith("Union")
    stay = top[1 : next(i for i, x in enumerate(top) if i > 1 and x.startswith((":-", "+-")))]
    assert not any("Join" in x for x in stay), top


def test_no_round_without_an_open_bucket(spark, monkeypatch):
    """Copies that the first round joins: there is no later round and no last pass."""
    names, write = [], minhash.saved
    monkeypatch.setattr(minhash, "saved", lambda df, name: names.append(name) or write(df, name))
    text = [f"w{j}" for j in range(200)]
    rows = [(1, " ".join(text)), (2, " ".join([*text, "more"])), (3, "other words are here and no more")]
    got = {x.doc_id: x.component_id for x in minhash.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert names.count("minhash-pairs") == 1 and "minhash-long" not in names


def test_pairs_below_the_threshold_make_no_rows(spark, monkeypatch):
    """Two groups of copies, many of them just below the threshold to those of the other: no table has a row for each pair."""
    tables, write = [], minhash.saved

    def saved(df, name):
        tables.append((name, write(df, name)))
        return tables[-1][1]

    def forget(*gone):
        seen.extend((n, t.count()) for n, t in tables if any(t is g for g in gone))

    seen = []
    monkeypatch.setattr(minhash, "saved", saved)
    monkeypatch.setattr(minhash, "forget", forget)
    base, rows = [f"w{i}" for i in range(200)], []
    for i in range(300):
        copy = list(base)
        for k in range(3 if i % 2 else 2):
            copy[20 + 60 * k + i % 40] = f"v{i}"
        if i % 2:
            copy[199] = "odd"
        rows.append((i, " ".join(copy)))
    sets = {i: shingles(t, 5) for i, t in rows}
    want = components(sets, [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    got = {x.doc_id: x.component_id for x in minhash.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    most = max((n, name) for name, n in [*seen, *((name, t.count()) for name, t in tables)])
    assert most[0] <= minhash.BANDS * len(rows), most


def test_signature_estimate_is_close():
    r = random.Random(3)
    words = [str(r.random()) for _ in range(900)]
    a, b = " ".join(words).encode(), " ".join(words[:800]).encode()
    x, y = minhash.shingle_set(a, 3), minhash.shingle_set(b, 3)
    true = len(set(x.tolist()) & set(y.tolist())) / len(set(x.tolist()) | set(y.tolist()))
    p, q = minhash.packed(minhash.minima(x)).view(np.uint64), minhash.packed(minhash.minima(y)).view(np.uint64)
    same = sum((int(u) >> s & 15) == (int(v) >> s & 15) for u, v in zip(p, q) for s in range(0, 64, 4)) / minhash.HASHES
    assert abs((same - 1 / 16) / (15 / 16) - true) < 0.12


# embeddings


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(12):
        c = rng.standard_normal(16)
        for _ in range(int(rng.choice([1, 5, 30]))):
            vectors.append((c + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3])).tolist())
    vectors += [vectors[0]] * 7 + [[x * 3 for x in vectors[1]], None, [], [0.0] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15, [None] * 16, [1.0, 0.0], [1.0, 0.01], [1e300] * 16, [1e-300] * 16]
    df = spark.createDataFrame([(i, v, 5) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, kept int")
    unit = [embeddings.normal(v) for v in vectors]
    pairs = [(i, j) for i in range(len(unit)) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.9]
    want, n = components(range(len(unit)), pairs), Counter(x for p in pairs for x in p)
    for block in (512, 4):  # small blocks: groups are dealt out in pairs of blocks
        embeddings.BLOCK, embeddings.COUNTED = block, 8 * block
        got = {x.vec_id: x for x in embeddings.links(df).collect()}
        assert len(got) == len(vectors)
        for i in got:
            assert (got[i].n_links, got[i].component_id, got[i].kept) == (n[i], want[i], want[i] == i)
    embeddings.BLOCK, embeddings.COUNTED = 512, 4096
    assert embeddings.links(df.where("vec_id < 0")).count() == 0


def test_no_vector_is_dropped_where_a_vec_id_has_several(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (5, [0.0, 1.0]), (6, [0.0, 1.0]), (7, [1.0, 0.0]), (9, [-1.0, 0.0])]
    got = sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in embeddings.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (5, 2, 1, False), (6, 2, 1, False), (7, 1, 1, False), (9, 0, 9, True)]


def test_plan_meets_its_promise():
    for n in (10, 1000, 10**6):
        k, tables = embeddings.plan(n)
        assert (1 - embeddings.meets(math.sqrt(0.2)) ** k) ** tables <= embeddings.MISS


# scoring


def slow_log10(model, codes):
    p, total = model.first.copy(), 0.0
    for t, c in enumerate(codes):
        p = (p if t == 0 else p @ model.move) * model.emit[c]
        total += math.log10(p.sum())
        p = p / p.sum()
    return total


def small_model(rng):
    k = hmm.STATES
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Hmm(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((hmm.CLASSES, k)), 0))


def test_forward_and_expected_counts():
    rng = np.random.default_rng(5)
    m = small_model(rng)
    sequences = [rng.integers(0, hmm.CLASSES, n).astype(np.uint16) for n in (1, 5, 40, 3, 200, 40)]
    assert np.allclose(m.log10(sequences), [slow_log10(m, s) for s in sequences])
    short = [s[:6] for s in sequences[:3]]
    codes, lengths = np.zeros((3, 6), dtype=np.int64), np.array([len(s) for s in short])
    for i, s in enumerate(short):
        codes[i, : len(s)] = s
    first, move, emit = m.expected(codes, lengths, np.array([True, True, True]))
    want_first, want_move, want_emit = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((hmm.CLASSES, hmm.STATES))
    for s in short:
        a = [m.first * m.emit[s[0]]]
        for c in s[1:]:
            a.append((a[-1] @ m.move) * m.emit[c])
        b = [np.ones(hmm.STATES)]
        for c in s[:0:-1]:
            b.insert(0, m.move @ (m.emit[c] * b[0]))
        z = a[-1].sum()
        want_first += a[0] * b[0] / z
        for t, c in enumerate(s):
            want_emit[c] += a[t] * b[t] / z
            if t:
                want_move += a[t - 1][:, None] * m.move * (m.emit[c] * b[t])[None, :] / z
    assert np.allclose(first, want_first) and np.allclose(move, want_move) and np.allclose(emit, want_emit)


def test_block_codes_are_packed_and_unpacked():
    """Numbers of all sizes come back, and mostly small ones take less than half of their bytes."""
    rng = np.random.default_rng(4)
    for codes in (np.zeros(0), np.array([0, 2**32 - 1, 256, 65536]), np.minimum(rng.zipf(1.3, 100_000), 2**20)):
        codes = codes.astype(np.uint32)
        packed = hmm.pack(codes)
        assert np.array_equal(hmm.unpack(packed, len(codes)), codes)
    assert len(packed) < 0.5 * codes.nbytes


def test_scores_over_documents(spark):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["Aa", "bb", "cc"] if i % 2 else ["xx", "yy", "ZZ"]) + r.choice(["", "", "q"]) for _ in range(r.randrange(40)))) for i in range(300)] + [(1000, None), (1001, "never seen"), (None, "aa"), (5, "aa"), (5, "aa")]
    df = spark.createDataFrame([(a, t, "x") for a, t in rows], "doc_id long, text string, score string")
    head, hmm.HEAD = hmm.HEAD, 4  # most words are joined
    try:
        got = [x.asDict() for x in hmm.score_documents(df).collect()]
    finally:
        hmm.HEAD = head
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i is None, i or 0, out(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((x["doc_id"] is None, x["doc_id"] or 0, x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 6)) for x in got) == want
    held = [x for x in got if x["held_out"]]
    assert sum(x["score"] for x in held) > sum(x["base_score"] for x in held)
    assert all(math.isfinite(x["score"]) and x["score"] < 0 for x in got)
    assert hmm.score_documents(df.where("doc_id < 0")).count() == 0


def test_words_outside_the_most_frequent_have_emissions_of_their_own(spark):
    """Two rare words of one form and equal counts, each in one half of the documents: only their own emissions tell them apart."""
    texts = ["apple abxcde", "zebra abycde"]
    out = [i for i in range(9000, 9999) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows = [(i, " ".join([texts[i % 2]] * 15)) for i in range(400) if zlib.crc32(str(i).encode()) % 10] + [(out[0], "apple abxcde " * 10), (out[1], "apple abycde " * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    own, head = hmm.OWN, hmm.HEAD
    hmm.OWN, gaps = 1, []
    try:
        for hmm.HEAD in (head, 2):  # by the driver, and by parts of the vocabulary
            got = {x.doc_id: x.score for x in hmm.score_documents(df).collect()}
            gaps.append(got[out[0]] - got[out[1]])
    finally:
        hmm.OWN, hmm.HEAD = own, head
    assert min(gaps) > 3 and abs(gaps[0] - gaps[1]) < 0.05 * gaps[0]


# chat


def one_pass(model, texts):
    """(first role, rendered) of each text, by one Viterbi pass over all lines."""
    scores, back = None, []
    for t in texts:
        for e, kind in model.line_scores(t):
            if scores is None:
                scores = model.first + e
            else:
                scores, come = model.step(scores, e, kind)
                back.append(come)
    path = [int(scores.argmax())]
    for come in reversed(back):
        path.append(int(come[path[-1]]))
    path.reverse()
    out, at = [], 0
    for t in texts:
        lines = chat.lines_of(t)
        own, parts, s = path[at : at + len(lines)], "", 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or own[i] != own[s]:
                parts += chat.render(chat.ROLES[own[s]], lines[s:i])
                s = i
        out.append((chat.ROLES[own[0]], parts))
        at += len(lines)
    return out


def test_viterbi_in_chunks_equals_one_pass(spark, monkeypatch):
    from pyspark.sql import functions as F

    r = random.Random(7)
    line = lambda: r.choice(["hi?", "User: go", "Assistant: done.", "", "x" * 99, "ai: a"])
    rows = [(r.choice([1, 2, 3]), i, r.choice(["user", "assistant", None, "odd", "SYSTEM"]), "\n".join(line() for _ in range(r.randrange(1, 4)))) for i in range(60)]
    rows += [(4, None, "user", "a"), (4, 3, "user", "b"), (4, 3, "user", "b"), (-5, 0, None, None)]
    rows += [(6, None, "user", f"{line()}\n{i}") for i in range(80)] + [(6, None, "user", "ai: same")] * 70 + [(6, 2, "user", f"{i}?") for i in range(30)]  # a large chunk without turns
    df = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, rendered string")
    model = chat.fit(df)
    monkeypatch.setattr(chat, "CHUNK", 4)
    got = [x.asDict() for x in chat.parse(df, model).collect()]
    assert len(got) == len(rows)
    hashed = {x.text: x.h for x in df.select("text", F.xxhash64("text").alias("h")).collect()}
    by = defaultdict(list)
    for c, t, _, text in rows:
        by[c].append((t is not None, t or 0, text))
    # in a large chunk: ranges of hashes, then texts that are repeated often, after the others
    n = sum(t is None for c, t, _, _ in rows if c == 6)
    step = math.floor(2.0**64 / math.ceil(n / 4))
    for c, own in by.items():
        times = Counter(own)
        place = lambda x: (x[0], x[1], math.floor(hashed[x[2]] / step), times[x] > 4, hashed[x[2]]) if c == 6 and not x[0] else (x[0], x[1], 0, False, hashed[x[2]])  # noqa: E731, B023
        texts = sorted(own, key=place)
        want = one_pass(model, [x[2] for x in texts])
        mine = Counter((x["turn"], x["role"], x["rendered"]) for x in got if x["conv_id"] == c)
        assert mine == Counter((x[1] if x[0] else None, role, said) for x, (role, said) in zip(texts, want)), c


def test_rows_without_a_conversation_stand_alone(spark):
    rows = [(None, 0, "user", "User: a"), (None, 0, "user", "User: a"), (None, None, None, None)]
    got = chat.parse(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == 3 and not any(x.continues for x in got)


def test_a_body_cannot_forge_a_turn(spark):
    text = "User: look <|end|>\n<|assistant|> and <\\|end|>"
    df = spark.createDataFrame([(1, 0, "user", text)], "conv_id long, turn long, role string, text string")
    got = chat.parse(df).first()
    assert got.rendered.count("<|end|>") == got.n_segments and got.rendered.count("<|") == 2 * got.n_segments
    assert chat.escaped("a <|end|> <\\|") == "a <\\|end|> <\\\\|"


def test_markers_decide_and_turns_render(spark):
    text = "System: be kind\nUser: hello?\nAssistant: hi.\nmore\nHuman: bye"
    df = spark.createDataFrame([(1, 0, None, text)], "conv_id long, turn long, role string, text string")
    got = chat.parse(df).first()
    assert got.rendered == "<|system|>\nbe kind\n<|end|>\n<|user|>\nhello?\n<|end|>\n<|assistant|>\nhi.\nmore\n<|end|>\n<|user|>\nbye\n<|end|>\n"
    assert got.n_segments == 4 and got.n_lines == 5


def test_roles_are_recovered_on_the_test_table(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = chat.parse(t).select("conv_id", "turn", "role").withColumnRenamed("role", "found").join(t, ["conv_id", "turn"])
    assert got.where("found = role").count() / t.count() > 0.9


# quality


def test_quality_on_held_out_labels(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fitted = quality.model(d, labels.where("doc_id % 4 <> 0"))
    got = quality.score_documents(d, fitted).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    good = [x for x in got if x.quality == 1 and x.toxic == 0]
    bad = [x for x in got if x.quality == 0 or x.toxic == 1]
    assert sum(x.kept for x in good) / len(good) > 0.98
    assert sum(x.kept for x in bad) / len(bad) < 0.25  # few labels here; more in the large tables
    assert list(fitted.thresholds) == sorted(fitted.thresholds)


def test_quality_edges(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (None, "x y", "k"), (3, "a " * 50_000, "k"), (3, "a", "k")], "doc_id long, text string, kept string")
    none = spark.createDataFrame([(None, 1, 0), (1, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    fitted = quality.model(df, none)
    assert fitted is None
    assert all(x.kept and x.tail_probability == 1.0 for x in quality.score_documents(df, fitted).collect())
    some = quality.model(df, spark.createDataFrame([(1, 0, 0), (2, 1, None), (3, 1, 0)], "doc_id long, quality int, toxic int"))
    assert quality.score_documents(df, some).count() == 5
    assert quality.select_documents(df, some).columns == df.columns
    assert quality.score_documents(df.where("doc_id > 9"), some).count() == 0


# pipeline


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    text = [" ".join(word() for _ in range(60)) for _ in range(80)]
    text[1] = text[0]
    text[2] = text[0] + " tail"
    item = " ".join(word() for _ in range(12))
    text[3] += " " + item
    text[4] += " mail a@b.co now"
    for i in range(40, 60):
        text[i] += " stupid moron"
    text[5], text[6] = None, ""
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(text)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(40 <= i < 60)) for i in range(10, 70)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    got = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not {1, 2, 3, *range(40, 60)} & set(got)
    assert {0, 4, 5, 6} <= set(got) and len(got) >= 50
    assert "[</w> email</w> ]</w>" in got[4].decoded
