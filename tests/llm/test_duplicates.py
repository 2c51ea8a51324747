"""Exact and near duplicates and line alignment against brute force."""

import hashlib
import random

import pytest
import xxhash

from textquarry.llm import components, exact, lines, shingles, simhash

from .rows import awkward, empty, frame


def plain_print(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance):
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                group[find(a)] = find(b)
    order = lambda i: -1 if i is None else i
    least = {}
    for k, (i, _) in enumerate(rows):
        g = find(k)
        least[g] = min([least.get(g, i), i], key=order)
    return sorted(((i, f"{p:016x}", least[find(k)]) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=repr)


@pytest.mark.parametrize("piece", [4096, 1])
def test_simhash(spark, piece, monkeypatch):
    rows = awkward(4, 90)
    whole = simhash.links
    monkeypatch.setattr(simhash, "links", lambda d, n: whole(d, n, piece))
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got), key=repr) == brute_components(rows, 4)


def test_simhash_links_all(spark):
    pick = random.Random(3)
    base = [pick.getrandbits(64) for _ in range(30)]
    prints = sorted({b ^ sum(1 << pick.randrange(64) for _ in range(pick.randrange(6))) & (1 << 64) - 1 for b in base for _ in range(12)})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for piece in (4096, 2):
        edges = simhash.links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), 4, piece)
        roots = {r.node: r.root for r in components.components(edges).collect()}
        group = {p: roots.get(signed(p), signed(p)) for p in prints}
        seen = {}
        for a in prints:
            stack, reach = [a], {a}
            while stack:
                x = stack.pop()
                for y in prints:
                    if y not in reach and (x ^ y).bit_count() <= 4:
                        reach.add(y)
                        stack.append(y)
            seen[a] = reach
        assert all(group[a] == min(map(signed, seen[a])) for a in prints)


def test_simhash_empty(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    pick = random.Random(1)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {x: got.get(x, x) for x in label} == label


def test_exact(spark):
    rows = awkward(5) + [(100, "Ärger A"), (101, "Ärger a"), (102, "ärger a")]
    got = exact.exact_groups(frame(spark, rows)).collect()
    normal = lambda t: (t or "").encode().lower()
    want = []
    for i, t in rows:
        same = [j for j, u in rows if normal(u) == normal(t)]
        keep = max(same, key=lambda j: -1 if j is None else j)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(normal(t)).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert exact.exact_groups(empty(spark)).count() == 0


def test_alignment_is_a_common_subsequence():
    pick = random.Random(2)
    for _ in range(200):
        a = [pick.randrange(8) for _ in range(pick.randrange(15))]
        b = [pick.randrange(8) for _ in range(pick.randrange(15))]
        found = sorted(lines.aligned(a, b))
        rest = iter(b)
        assert all(a[k] in rest for k in found) and len(set(found)) == len(found)
        assert sorted(lines.aligned(a, a)) == list(range(len(a)))


def brute_lines(rows, rare, several, whole=None):
    """First holders, overlap rule and alignment, one document after the other."""
    order = lambda r: ((-1 << 63) if r[0] is None else r[0])
    docs = sorted({(i, t or "") for i, t in rows}, key=order)
    keys = [{x.strip(" ") for x in t.split("\n") if x.strip(" ")} for _, t in docs]
    held = {}
    for k, own in enumerate(keys):
        for x in own:
            held.setdefault(x, []).append(k)
    out = {}
    for k, (i, t) in enumerate(docs):
        shared = {}
        for x in keys[k]:
            if held[x][0] < k:
                shared.setdefault(held[x][0], []).append(len(held[x]))
        mine, gone, copy = [x.strip(" ") for x in t.split("\n")], set(), False
        for other, counts in shared.items():
            if min(counts) <= rare or len(counts) >= min(several, len(keys[k])):
                found = lines.aligned(mine, [x.strip(" ") for x in docs[other][1].split("\n")])
                gone |= set(found)
                copy |= whole is not None and sum(len(mine[n]) for n in found) >= whole * sum(map(len, mine))
        gone = set() if copy else gone
        out[(i, t)] = ("\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone), len(gone))
    return out


def test_lines(spark):
    pick = random.Random(9)
    texts = ["\n".join(pick.choice([" ", "footer"] + [f"line {n} " for n in range(25)]) for _ in range(pick.randrange(9))) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(90, texts[5]), (90, texts[5]), (91, None), (92, ""), (93, "new\n" + texts[7] + "\nlast")]
    got = lines.dedup_lines(frame(spark, rows), rare=3, several=3)
    assert {"lang", "source", "th", "spans"} <= set(got.columns)
    want = brute_lines(rows, 3, 3)
    for r in got.collect():
        key = next((i, t) for i, t in rows if i == r.doc_id and ((t or "") == r.text or want[(i, t or "")][0] == (r.text or "")))
        assert ((r.text or ""), r.n_deleted) == want[(key[0], key[1] or "")]
    assert got.count() == len(rows)
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_common_lines(spark):
    """A line goes from every later document however many hold it, alone or with lines first held elsewhere."""
    notice = " ".join(f"word{n}" for n in range(57))
    rows = [(k, f"own {k}\n{notice}\nend {k}") for k in range(30)]
    rows += [(100 + k, f"first {k}\npart {n}") for n in range(3) for k in range(12 * n, 12 * n + 12)]
    rows += [(200, "part 0\npart 1\npart 2\nlast")]
    got = {r.doc_id: (r.text, r.n_deleted) for r in lines.dedup_lines(frame(spark, rows)).collect()}
    assert got == {i: brute_lines(rows, len(rows), 1)[(i, t)] for i, t in rows}
    assert sum(notice in t for t, _ in got.values()) == 1 and got[200] == ("last", 3)


def five_words(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_similar(rows):
    """Components over pairs whose five-word shingles have a Jaccard similarity of 4/5 or more: each row's partners."""
    sets = [five_words(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return label


def edited(pick, words, n):
    words = list(words)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10 ** 6)}"
    return " ".join(words)


@pytest.mark.parametrize("bits", [26, 10])
def test_similar_shingles(spark, bits):
    """Exactly the pairs at 4/5 or more are linked, in small groups and in a large one, however full the sketch."""
    pick = random.Random(6)
    rows = awkward(4, 60)
    for g in range(25):
        base = [f"w{pick.randrange(400)}" for _ in range(pick.randrange(30, 160))]
        rows += [(1000 + 10 * g + k, edited(pick, base, pick.randrange(1 + len(base) // 25))) for k in range(4)]
    hot = [f"h{k}" for k in range(120)]
    rows += [(5000 + k, edited(pick, hot, pick.randrange(6))) for k in range(60)]
    rows += [(6000, " ".join(hot).upper()), (6001, "a b c"), (6002, "A b  c"), (6003, "a b d")]
    got = shingles.near_duplicates(frame(spark, rows), bits=bits).collect()
    want, by_text = brute_similar(rows), {}
    for (_, t), x in zip(rows, want):
        by_text[t or ""] = x
    hashes = {r.th: r.t for r in spark.createDataFrame([(t,) for t in by_text], "t string").selectExpr("t", "xxhash64(t) th").collect()}
    pairs = {(by_text[hashes[r.th]], r.root) for r in got}
    assert len(got) == len(rows) and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    far = [(a, b) for a in range(len(rows)) for b in range(a) if want[a] == want[b] and (plain_print(rows[a][1]) ^ plain_print(rows[b][1])).bit_count() > 4]
    assert far
    assert shingles.near_duplicates(empty(spark)).count() == 0


def test_similar_in_a_dense_group(spark, monkeypatch):
    """Many near copies of one text, partly below 4/5 of one another: the rounds leave little to the last join and lose nothing."""
    pick = random.Random(8)
    base = [f"h{k}" for k in range(120)]
    rows = [(k, edited(pick, base, pick.randrange(1, 4))) for k in range(90)] + [(100 + k, " ".join(f"v{pick.randrange(900)}" for _ in range(50))) for k in range(5)]
    verified, inner = [], shingles.similar

    def counting(pairs, sets):
        verified.append(pairs.count())
        return inner(pairs, sets)

    monkeypatch.setattr(shingles, "similar", counting)
    want, last = brute_similar(rows), {}
    order = {r.th: r.doc_id for r in frame(spark, rows).selectExpr("doc_id", "xxhash64(text) th").collect()}
    place = {i: n for n, (i, _) in enumerate(rows)}
    for turns in (0, shingles.TURNS):
        monkeypatch.setattr(shingles, "TURNS", turns)
        pairs = {(want[place[order[r.th]]], r.root) for r in shingles.near_duplicates(frame(spark, rows), bits=18).collect()}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(set(want))
        last[turns] = verified[-1]
    assert last[shingles.TURNS] < last[0] / 2, (last, verified)


def test_stars_are_seen_without_a_round(spark, monkeypatch):
    """Edges that already tie every node to its least one are the result; others are not taken for it."""
    frame_of = lambda edges: spark.createDataFrame(edges, "a long, b long")
    stars = [(5, 1), (1, 7), (9, 2), (9, 9), (5, 1)]
    for edges in ([(3, 2), (2, 1)], [(3, 1), (3, 2)], [(1, 3), (2, 3)]):
        assert {(r.node, r.root) for r in components.components(frame_of(edges)).collect()} == {(2, 1), (3, 1)}
    monkeypatch.setattr(components, "_small_star", None)
    assert sorted(map(tuple, components.components(frame_of(stars)).collect())) == [(5, 1), (7, 1), (9, 2)]
    assert components.components(frame_of([])).isEmpty()
