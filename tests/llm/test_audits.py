"""Source divergence and the Merkle manifest against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flightlake.llm import manifest as mf
from flightlake.llm import queries, source_audit
from flightlake.llm.common import table
from tests.llm.fixtures import ROWS, documents, empty

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_audit(rows, least_docs):
    rows = [(r["lang"] or "", r["source"] or "", TERM.findall((r["text"] or "").translate(LOWER))) for r in rows]
    docs = Counter((lang, t) for lang, _, ts in rows for t in set(ts))
    kept = defaultdict(set)
    for (lang, t), n in docs.items():
        if n >= least_docs:
            kept[lang].add(t)
    counts = defaultdict(Counter)
    for lang, source, ts in rows:
        counts[lang, source].update(t for t in ts if t in kept[lang])
    out = set()

    def shares(c, v):
        n = sum(c.values()) + 5 * len(v)
        return {t: 1 + 10**9 * (c[t] + 5) // n for t in v}

    for lang in {k[0] for k in counts}:
        v = kept[lang]
        of = {s: shares(c, v) for (x, s), c in counts.items() if x == lang}
        whole = shares(sum((c for (x, _), c in counts.items() if x == lang), Counter()), v)
        for s, p in of.items():
            pairs = sorted((-sum(abs(p[t] - q[t]) for t in v), o.encode()) for o, q in of.items() if o != s)
            out |= {(lang, s, "pair", o.decode(), -f, i + 1) for i, (f, o) in enumerate(pairs)}
            over = sorted((whole[t] - p[t], t.encode()) for t in v if counts[lang, s][t] and p[t] > whole[t])
            out |= {(lang, s, "term", t.decode(), -f, i + 1) for i, (f, t) in enumerate(over[:50])}
    return out


def audited(docs, **options):
    rows = [tuple(r) for r in source_audit.audit(docs, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_perfect_hashes_are_minimal_and_reject_strangers():
    rng = random.Random(1)
    for n in (1, 2, 5, 700):
        keys = sorted({rng.randbytes(rng.randint(1, 9)).replace(b" ", b"x") for _ in range(n)})
        rows = pa.table({"lang": ["en"] * len(keys), "term": pa.array(keys, pa.binary()), "shard": [0] * len(keys), "shards": [1] * len(keys)})
        held = source_audit.TermTable(source_audit.build_shard(rows))
        assert sorted(held.slots("en", keys).tolist()) == list(range(len(keys)))
        assert (held.slots("en", [k + b"!" for k in keys]) == -1).all()


def test_terms_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(source_audit, "term_hash", lambda keys: np.array([len(k) for k in keys], np.uint64))
    keys = [b"ab", b"cd", b"ef", b"ghi"]
    rows = pa.table({"lang": ["en"] * 4, "term": pa.array(keys, pa.binary()), "shard": [0] * 4, "shards": [1] * 4})
    held = source_audit.TermTable(source_audit.build_shard(rows))
    assert sorted(held.slots("en", keys).tolist()) == [0, 1, 2, 3]
    assert held.slots("en", [b"zz", b"xyz"]).tolist() == [-1, -1]


def test_terms_of_long_texts_come_in_pieces(monkeypatch):
    text = "Ünder_score, Straße42x é\x00z " * 50
    whole = [t for piece in source_audit.terms(text.encode()) for t in piece]
    assert whole == [t.encode() for t in TERM.findall(text.translate(LOWER))]
    monkeypatch.setattr(source_audit, "PIECE", 7)
    pieces = list(source_audit.terms(text.encode()))
    assert len(pieces) > 20 and [t for p in pieces for t in p] == whole


def test_shares_are_exact_for_very_large_counts():
    counts, totals = np.array([[3, 10**13], [0, 7]]), np.array([[5 * 10**13], [9]])
    found = source_audit.share(counts, totals, 11)
    assert found.tolist() == [[1 + 10**9 * (c + 5) // (t + 55) for c in row] for row, (t,) in zip(counts.tolist(), totals.tolist())]


def test_audit_is_plain_python(spark, monkeypatch):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "été", "日本", "omega", "x1y"]
    rows = [
        (i, " ".join(rng.choices(words[: rng.randint(1, 7)], k=rng.randint(0, 40))), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "ü", None]), 0)
        for i in range(300)
    ]
    rows += ROWS + [(900, "lonely", "xx", "only", 1), (901, None, "yy", "p", 1), (902, "", "yy", "q", 1)]
    docs = documents(spark, rows)
    expected = plain_audit(docs.collect(), 5)
    assert {r[2] for r in expected} == {"pair", "term"} and any(r[4] == 0 for r in expected)
    clashing = docs.withColumns({c: F.lit(1) for c in ("slot", "shard", "n", "term", "kept", "value", "rank", "part")})
    assert audited(clashing, least_docs=5) == expected
    monkeypatch.setattr(source_audit, "SHARD_KEYS", 2)
    assert audited(docs, least_docs=5, most_keys=3) == expected
    assert audited(empty(spark)) == set()


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(r, text):
    parts = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return digest("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def climb(nodes):
    """(top, path per node): path is a list of (place, run) up to the top."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for i, p in enumerate(at):
            paths[i].append((p % 3, runs[p // 3]))
            at[i] = p // 3
        nodes = [digest("".join(run)) for run in runs]
    return (nodes[0] if nodes else None), paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        odd = r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 2
        now = r["text"] if odd or r["text"] is None else r["text"].replace("\n", "")
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), plain_leaf(r, now), r["doc_id"]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf for _, _, leaf, _, _ in sorted(groups[s])]) for s in names}
    root, above = climb([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (_, _, leaf, changed, doc_id), path in zip(sorted(groups[s]), trees[s][1]):
            node, siblings = changed, []
            for place, run in path + up:
                siblings += run[:place] + run[place + 1 :]
                node = digest("".join([*run[:place], node, *run[place + 1 :]]))
            out.append((doc_id, leaf, trees[s][0], root, digest("".join(siblings)), node, node == root))
    return sorted(out, key=repr)


def folded(spark, docs, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    return sorted((tuple(r) for r in queries.op12_merkle_manifest(spark, "").collect()), key=repr)


@pytest.mark.parametrize("levels", [5, 1])
def test_manifest_is_plain_python(spark, monkeypatch, levels):
    monkeypatch.setattr(mf, "LEVELS", levels)
    monkeypatch.setattr(mf, "SPAN", 3**levels)
    rows = ROWS + [(i, f"line {i}\nnext", "en", "ü" if i % 9 else "hot", i) for i in range(100, 260)]
    docs = documents(spark, rows)
    found = folded(spark, docs.withColumns({c: F.lit(7) for c in ("hash", "tree", "pos", "row", "group", "id", "leaf")}), monkeypatch)
    assert found == plain_manifest(docs.collect())
    assert {r[-1] for r in found} == {True, False}
    one = docs.where("doc_id = 7")
    assert folded(spark, one, monkeypatch) == plain_manifest(one.collect())
    assert folded(spark, empty(spark), monkeypatch) == []


def test_manifest_of_the_whole_table(spark, sf_dir):
    found = sorted((tuple(r) for r in queries.op12_merkle_manifest(spark, sf_dir).collect()), key=repr)
    assert found == plain_manifest(table(spark, sf_dir, "documents").collect())


def test_folding_hashes_no_left_sibling():
    nodes = [digest(str(i)).encode() for i in range(25)]
    part = mf.Subtree(nodes, mf.levels_of(len(nodes)))
    top, paths = climb([n.decode() for n in nodes])
    assert part.rows[-1] == [top.encode()]
    for i in range(25):
        assert part.fold(i, nodes[i]) == top.encode()
        assert [(a + b).decode() for a, b in part.path(i)] == ["".join(r[:p] + r[p + 1 :]) for p, r in paths[i]]
        part.rows[0] = [*[b"?"] * i, *nodes[i:]]
        assert part.fold(i, nodes[i]) == top.encode()
        part.rows[0] = nodes
