"""Spelling variants, conversation repair and the subspace join against brute force, on rows of all kinds."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pytest

from tallyloom.llm import conversation_repair, ngram_join, spelling_variants, subspace_join
from tallyloom.llm.fm_index import FmIndex


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters", ["ab", "abcé", "x"])
def test_fm_index_finds_one_error(letters):
    rnd = random.Random(7)
    words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(150)})
    asked = [*words, "zz", "abz", letters * 40]
    exact = np.array([len(a) // 2 for a in asked])
    got = FmIndex(words).one_error(asked, exact)
    want = {(i, j) for i, a in enumerate(asked) for j, w in enumerate(words) if w.startswith(a[: exact[i]]) and near(a, w)}
    assert sorted(zip(*(g.tolist() for g in got), strict=True)) == sorted(want)


def variants(counts, ratio=2):
    forms = {}
    for w, n in counts.items():
        close = sorted((-m, v) for v, m in counts.items() if v != w and near(v, w))
        best = close[0] if close and -close[0][0] >= ratio * n else None
        forms[w] = (best and best[1], n, len(close), best and -best[0])

    def root(w):
        return root(forms[w][0]) if forms[w][0] else w

    return {w: (f, root(w), n, k, m) for w, (f, n, k, m) in forms.items()}


@pytest.mark.parametrize("shard_letters", [40, 500_000])
def test_variants_against_brute_force(spark, monkeypatch, shard_letters):
    monkeypatch.setattr(spelling_variants, "SHARD_LETTERS", shard_letters)
    rnd = random.Random(11)
    words = {"".join(rnd.choice("aabé") for _ in range(rnd.randint(1, 7))) for _ in range(250)} | {"hot" * 3 + c for c in "abcdefgh"}
    counts = {w: rnd.choice([1, 2, 3, 5, 9, 40]) for w in words} | {"y" * 3000: 4, "y" * 3001: 9}
    rows = [(w, n, "x") for w, n in counts.items() if w != "hothothota"] + [("hothothota", 1, None), (None, 5, "y"), ("", 3, None), ("null", None, "")]
    rows += [("hothothota", counts["hothothota"] - 1, "again")] if counts["hothothota"] > 1 else []
    got = spelling_variants.group_variants(spark.createDataFrame(rows, "word string, n long, near string"))
    assert {r["word"]: tuple(r)[1:] for r in got.collect()} == variants(counts)


def test_variants_of_nothing(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling_variants.group_variants(none).count() == 0
    one = spark.createDataFrame([("alone", 3)], "word string, n long")
    assert [tuple(r) for r in spelling_variants.group_variants(one).collect()] == [("alone", None, "alone", 3, 0, None)]


def test_damaged_words(spark):
    import zlib

    rows = [(i, "Hello Élan WORLD don't ×÷abc " + "q" * i) for i in range(300)] + [(None, "Null id"), (1, None), (2, "")]
    got = collections.Counter(r["word"] for r in spelling_variants.damaged_words(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = collections.Counter()
    for i, text in rows:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            run = run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 5
    assert got == +want


def repaired(rows):
    """The result for the rows of one conversation, by trying audits from the cheapest on, letter by letter."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        ink = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {(0, 0, False): (0, "", ())}  # rows read, turns written, system row written
    goals, frontier = [], best
    for i in range(len(rows) + 1):
        for _ in range(2):  # an insertion more than twice in a place never pays
            for (at, n, s), (cost, audit, out) in list(frontier.items()):
                value = (cost + 2, audit + "I", (*out, ("user", "assistant")[n % 2] + ":"))
                frontier[at, n + 1, s] = min(frontier.get((at, n + 1, s), value), value)
        if i == len(rows):
            goals = [v for (_, n, s), v in frontier.items() if n % 2 == 0 and (n or not s)]
            break
        (_, role, text), fault, after = rows[i], faults[i], {}
        for (_, n, s), (cost, audit, out) in frontier.items():
            options = [((i + 1, n, s), (cost + 3, audit + "D", out))]
            if fault not in ("b", "d"):
                due, cost = ("user", "assistant")[n % 2], cost + (fault == "t")
                options.append(((i + 1, n + 1, s), (cost + 2, audit + "R", (*out, f"{due}:{text}"))))
                if role[:1] == due[0]:
                    options.append(((i + 1, n + 1, s), (cost, audit + "K", (*out, f"{role}:{text}"))))
                if role[:1] == "s" and not n and not s:
                    options.append(((i + 1, 0, True), (cost, audit + "K", (*out, f"{role}:{text}"))))
            for state, value in options:
                after[state] = min(after.get(state, value), value)
        frontier = after
    cost, audit, out = min(goals)
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
        illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def conversations():
    rnd = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["Yes.", "No", " \t", "", "Why? ", "Stop!\n", None, "long " * 400 + ".", "a.b"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randint(1, 9)):
            copy = (conv, rnd.choice([turn, turn, None, 0]), rnd.choice(roles[:2] + roles), rnd.choice(texts), "extra")
            rows += [copy] * rnd.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("chunk_rows", [1_024, 2])
def test_repair_against_brute_force(spark, chunk_rows):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair(df, chunk_rows=chunk_rows).collect()}
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {c: repaired(rs) for c, rs in by_conv.items()}


def test_repair_of_a_hot_conversation(spark):
    rows = [(7, t, "user" if t % 3 else "assistant", f"{t % 11}." if t % 5 else "cut") for t in range(3_000)] + [(8, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(tuple(r) for r in conversation_repair.repair(df, chunk_rows=10_000).collect())
    assert sorted(tuple(r) for r in conversation_repair.repair(df, chunk_rows=100).collect()) == whole
    assert conversation_repair.repair(df.limit(0)).count() == 0


def test_lightest_derivation_is_the_cheapest_audit():
    """Against all audits of short conversations."""
    cost_of = {"K": 0, "R": 2, "D": 3, "I": 2}
    for initials in itertools.product("usax", repeat=3):
        rows = [(i, "t" if k == 1 else "", 1) for k, i in enumerate(initials)]
        best = None
        for size in range(3, 8):
            for audit in map("".join, itertools.product("DIKR", repeat=size)):
                if len(audit.replace("I", "")) != 3:
                    continue
                state, at, cost = 0, 0, 0
                for edit in audit:
                    if edit != "I":
                        kept = conversation_repair.kept_state(state, rows[at][0]) if edit == "K" else state
                        cost += rows[at][1] == "t" and edit != "D"
                        at += 1
                        if kept is None:
                            break
                        state = kept
                    state = conversation_repair.AFTER[state] if edit in "RI" else state
                    cost += cost_of[edit]
                else:
                    if state in (0, 3):
                        best = min(best or (cost, audit), (cost, audit))
        assert list(conversation_repair.lightest(rows, 0, (0, 3)).values()) == [best]


def vectors():
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(12, 16))
    rows = []
    for i in range(400):
        v = centres[i % 12] + rnd.normal(size=16) * rnd.choice([0.02, 0.1, 0.4])
        rows.append((i, [float(x) for x in v.astype(np.float32)], [0, 0, 0, 1, None][i % 5], "x"))
    rows += [(1000 + i, rows[0][1], 0, "copy") for i in range(30)]
    rows += [(2000, [0.0] * 16, 0, ""), (2001, None, 0, ""), (2002, [], 0, ""), (2003, [float("nan")] + [1.0] * 15, 0, ""), (2004, [1.0, None], 0, "")]
    rows += [(2005, [float("inf")] + [1.0] * 15, 0, ""), (None, rows[0][1], 0, ""), (2006, [1.0, 2.0], 0, ""), (2007, [2.0, 4.0], 0, ""), (2008, [1e30, 2e30], 0, "")]
    return rows + [(0, rows[0][1], 0, "again"), (1, rows[0][1], 0, "another vector")]


def linked(rows, least=0.98):
    usable = {
        k: np.array(v, dtype=float) for k, (i, v, label, _) in enumerate(rows)
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    root = {k: k for k in usable}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    links = collections.Counter()
    for a, b in itertools.combinations(usable, 2):
        x, y = usable[a], usable[b]
        if rows[a][2] == rows[b][2] and len(x) == len(y) and (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= least:
            links.update((a, b))
            root[top(a)] = top(b)
    first = {}
    for k in usable:
        first[top(k)] = min(first.get(top(k), rows[k][0]), rows[k][0])
    out = []
    for k, (i, _, _, _) in enumerate(rows):
        component = first[top(k)] if k in usable else i
        out.append((i, links[k], component, True if i is None else i == component))
    return sorted(out, key=str)


@pytest.mark.parametrize("cell_rows,tile_rows", [(8_192, 2_048), (20, 2_048), (20, 16), (8_192, 50)])
def test_vectors_against_brute_force(spark, cell_rows, tile_rows):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    got = subspace_join.near_duplicates(df, cell_rows=cell_rows, tile_rows=tile_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == linked(rows)


def test_vectors_of_nothing(spark):
    assert subspace_join.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_blocks_share_the_whole_budget():
    for d in (1, 3, 8, 64, 100):
        turn = subspace_join.rotation(d)
        assert np.allclose(turn @ turn.T, np.eye(d))
        assert subspace_join.budgets(d, 0.98).sum() >= 0.04
        assert subspace_join.block_bounds(d)[-1] == d


def test_forest_joins_what_shares_the_shortest_prefix():
    rnd = np.random.default_rng(2)
    for blocks in (1, 2):
        rows = rnd.integers(0, 3, size=(60, 30)).astype("<u2")
        rows[10:20, 5:] = rows[0, 5:]
        trie, block = rows[:, :7], np.arange(60) % blocks
        alike = lambda a, b: (rows[a] == rows[b]).sum() >= 15
        edges = {(a, b) for a in range(60) for b in range(a) if (trie[a, :2] == trie[b, :2]).all() and alike(a, b)}
        # each block connects its own rows; the pair of blocks adds what joins the two
        got = ngram_join.trie_links(rows, trie, 2, 15, block)
        for one in range(blocks if blocks > 1 else 0):
            own = np.flatnonzero(block == one)
            got += [(own[a], own[b]) for a, b in ngram_join.trie_links(rows[own], trie[own], 2, 15, block[own])]

        def parts(links):
            root = list(range(60))
            for _ in range(60):
                for a, b in links:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        assert parts(got) == parts(edges)


def test_ids_with_several_vectors_are_as_near_as_the_nearest(spark):
    from tallyloom.llm import graph_search

    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [1.0, 0.5]), (4, [-1.0, 0.0]), (1, [0.0, -1.0]), (5, [0.1, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = graph_search.nearest(df, df.filter("vec_id = 1"), "vec_id", "v", k=3)
    cos = lambda a, b: float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))
    own = [v for i, v in rows if i == 1]
    best = {i: max(cos(a, v) for a in own for j, v in rows if j == i) for i in (2, 3, 4, 5)}
    want = sorted((-s, i) for i, s in best.items())[:3]
    found = [(r["vec_id"], r["score"]) for r in sorted(got.collect(), key=lambda r: r["rank"])]
    assert [i for i, _ in found] == [i for _, i in want] and all(abs(s + w) < 1e-12 for (_, s), (w, _) in zip(found, want, strict=True))


def test_pipeline_of_odd_rows_and_of_none(spark):
    import corpus_pipeline
    from tallyloom.session import scratch_path

    good = " ".join(f"word{i} and{i} then{i}" for i in range(40))
    rows = [(1, good, "en", "s", 900), (2, None, None, None, None), (None, good + " more", "en", "s", 5), (3, "", "en", "s", 0), (4, good, "en", None, 1), (1, good, "en", "s", 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some, least in ((docs, 1), (docs.limit(0), 0)):
        root = scratch_path(spark, "odd")
        some.write.parquet(f"{root}/documents.parquet")
        got = corpus_pipeline.run(spark, root).collect()
        assert len(got) >= least and {r["doc_id"] for r in got} <= {1, 4, None}
