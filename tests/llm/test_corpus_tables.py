"""Collocations, decontamination and the Merkle manifest against brute force, on small and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import tempfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewright.llm import collocations, decontaminate, fmindex, merkle, words
from tests.conftest import DATA
from tests.llm.test_llm import AWKWARD, SCHEMA, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def awkward(spark):
    clash = ("prefix", "next", "phrase", "part", "at", "m", "node", "n_hit", "hit_items", "items", "word", "a", "leaf", "s0")
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3).select("*", F.length("text").cast("long").alias("n_chars"), *[F.lit(7).alias(c) for c in clash])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", n_chars long")


def random_texts(seed: int, n: int, vocabulary: str = "a b C é. d\t,x") -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice([*vocabulary.split(" "), " ", " ", "\n"]) for _ in range(rng.randrange(60))) for _ in range(n)]


# words --------------------------------------------------------------------------------------------------


def test_words_match_a_pattern():
    texts = [None, "", "A b", " .x.é  y\n", "Z"] + random_texts(1, 50) + ["x" * n + " " + "y" * n for n in (7, 8, 9, 16, 17, 4000)]
    found = words.split_words(pa.array(texts, pa.string()).slice(1), collocations.KINDS)
    names, ids = found.coded()
    names = names.to_pylist()
    assert len({(h, i) for h, i in zip(found.hashes().tolist(), ids.tolist())}) == len(names) == len(set(found.hashes().tolist()))
    for r, text in enumerate(texts[1:]):
        own = found.row == r
        assert [names[i].decode() for i in ids[own]] == re.findall(r"[^\x20\x09.,;:!?\n-\r]+", text.translate(LOWER))
        raw = text.translate(LOWER).encode()
        assert [raw[a:b] for a, b in zip(found.start[own], found.end[own])] == [names[i] for i in ids[own]]


def test_chunks_keep_rows_and_bound():
    batches = [pa.record_batch([pa.array(["x" * (k % 7)] * 50)], ["text"]) for k in range(9)]
    out = list(words.chunks(iter(batches), "text", 40))
    assert [x for b in out for x in b.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]
    assert all(sum(map(len, b.column(0).to_pylist())) < 40 + 7 for b in out)


# 11 -----------------------------------------------------------------------------------------------------


def plain_collocations(items, least, longest, top, share=100):
    n, f = Counter(), Counter()
    for lang, text in items:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (text or "").translate(LOWER)):
            w = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    held = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = {}
    for p, a in held.items():
        if any(len(q) > len(p) and q[0] == p[0] and any(q[i : i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2)) and 100 * b >= share * a for q, b in held.items()):
            continue
        cuts = [(1000 * a * n[p[0]] // (f[p[: k + 1]] * f[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), f[p[: k + 1]], f[(p[0], *p[k + 1 :])]))
    return sorted((lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, found in out.items() for i, x in enumerate(sorted(found)[:top]))


@pytest.mark.parametrize("least,share", [(3, 100), (5, 80), (2, 100)])
def test_collocations(spark, least, share):
    rng = random.Random(least)
    texts = [(rng.choice(["en", None, "und", "é"]), t) for t in random_texts(least, 60)] + [("en", "Of the day of the day"), ("en", None), ("en", "")] * 3
    df = spark.createDataFrame(texts, "lang string, text string").repartition(4)
    found = sorted(tuple(r.values()) for r in rows(collocations.collocations(df, least, 5, 20, share)))
    assert found == plain_collocations(texts, least, 5, 20, share)


def test_collocation_filter_keeps_all_and_long_stripes_travel_in_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 128)  # nearly all bits set: only work grows
    monkeypatch.setattr(collocations, "STRIPE", 3)
    texts = [("en", t) for t in random_texts(9, 60)]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(2)
    assert sorted(tuple(r.values()) for r in rows(collocations.collocations(df, 3, 4, None))) == plain_collocations(texts, 3, 4, 10**9)


@pytest.mark.parametrize("held", [1 << 20, 600, 1])
@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_stripes_of_a_tasks_chunks_are_joined(monkeypatch, k, held):
    """A task of many chunks hands on one stripe a prefix, in parts of full length but the last; beyond HELD bytes it hands them on earlier. Counts are exact either way."""
    monkeypatch.setattr(collocations, "CHUNK", 300)
    monkeypatch.setattr(collocations, "HELD", held, raising=False)
    items = [(("en", "und", "é")[i % 3], t) for i, t in enumerate(random_texts(k, 90) + ["a b b A " * n for n in range(1, 9)] * 9)]
    batch = pa.record_batch([pa.array(x) for x in zip(*items)], ["lang", "text"])
    every = type("Bitmap", (), {"value": np.full(16, 255, np.uint8)}) if k > 1 else None
    out = [r for b in collocations._stripes(k, every, 2)(iter([batch])) for r in b.to_pylist()]
    found, plain = Counter(), Counter()
    for r in out:
        assert len(r["nexts"]) == len(r["counts"]) <= 2
        for word, n in zip(r["nexts"], r["counts"]):
            found[r["lang"], r["prefix"], word] += n
    for lang, text in items:
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", text.translate(LOWER)):
            w = re.findall("[^\\x20\\x09]+", piece)
            plain.update((lang, " ".join(w[i : i + k - 1]), w[i + k - 1]) for i in range(len(w) - k + 1))
            plain.update({(lang, "", None): len(w)} if k == 1 and w else {})
    assert found == plain
    stripes = Counter((lang, prefix) for lang, prefix, _ in plain)
    joined = sum((n + 1) // 2 for n in stripes.values())
    assert len(out) == joined if held == 1 << 20 else len(out) > joined


def test_tasks_hand_on_a_stripe_for_each_word(spark, monkeypatch, tmp_path):
    """All pairs of words are frequent, next to no longer phrases: rows handed on are at most one a task and word, and one a task and lang for the words themselves."""
    real = collocations._stripes

    def spied(*args):
        run, folder = real(*args), str(tmp_path)

        def counted(batches):
            made = 0
            for batch in run(batches):
                made += batch.num_rows
                yield batch
            with tempfile.NamedTemporaryFile("w", dir=folder, suffix=".rows", delete=False) as out:
                out.write(str(made))

        return counted

    monkeypatch.setattr(collocations, "_stripes", spied)
    rng = random.Random(4)
    vocabulary, tasks = [f"w{i}" for i in range(12)], 3
    texts = [("en", " ".join(rng.choices(vocabulary, k=400))) for _ in range(18)] + [("en", "w0 W1 w2 w3 w4 w5. ") for _ in range(60)]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(tasks)
    found = sorted(tuple(r.values()) for r in rows(collocations.collocations(df, 25, 5, None)))
    assert found == plain_collocations(texts, 25, 5, 10**9) and {2, 5} <= {len(r[2].split()) for r in found}
    made = sum(int(f.read_text()) for f in tmp_path.glob("*.rows"))
    assert 0 < made <= tasks * (1 + len(vocabulary))


@pytest.mark.parametrize("reach", [2, 3, 5])
def test_stripes_hold_all_that_follows_a_word(reach):
    """The stripe of a word counts what follows it in phrases of two to `reach` words, none beyond a piece, text or lang."""
    items = [(("en", "und")[i % 2], t) for i, t in enumerate(random_texts(reach, 90) + ["a", "", "a b", "b a a b A"])]
    batch = pa.record_batch([pa.array(x) for x in zip(*items)], ["lang", "text"])
    every = type("Bitmap", (), {"value": np.full(16, 255, np.uint8)})
    out = [r for b in collocations._stripes(2, every, 4096, reach)(iter([batch])) for r in b.to_pylist()]
    plain = Counter()
    for lang, text in items:
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", text.translate(LOWER)):
            w = re.findall("[^\\x20\\x09]+", piece)
            plain.update((lang, w[i], " ".join(w[i + 1 : i + k])) for k in range(2, reach + 1) for i in range(len(w) - k + 1))
    assert {(r["lang"], r["prefix"], x): n for r in out for x, n in zip(r["nexts"], r["counts"])} == plain
    assert len(out) == len({x[:2] for x in plain})


def test_collocation_scores_beyond_64_bits(spark):
    """Products of real counts pass 64 bits: the expression on given counts."""
    a = n = 10**12
    df = spark.createDataFrame([(a, n, 10**6, 10**6)], "a long, n long, l long, r long")
    assert df.select(F.expr(collocations.SCORE)).first()[0] == 1000 * a * n // 10**12


def test_collocations_awkward(spark, awkward, empty):
    assert collocations.collocations(empty).count() == 0
    items = [(lang, text) for _, text, lang, _ in AWKWARD]
    found = sorted(tuple(r.values()) for r in rows(collocations.collocations(awkward, 30)))
    assert found == plain_collocations(items, 30, 5, 2000)


# 12 -----------------------------------------------------------------------------------------------------


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(1)
    for trial in range(60):
        runs = [rng.integers(1, 4, rng.integers(1, 12)) for _ in range(rng.integers(1, 8))] * (1 + trial % 2)
        text = np.concatenate([np.append(r, 0) for r in runs])
        index = fmindex.FMIndex(text, 3, int(rng.choice([2, 5, 32])))
        patterns = [rng.integers(1, 4, rng.integers(1, 5)) for _ in range(10)]
        padded = np.array([[0] * (5 - len(p)) + p.tolist() for p in patterns])
        low, high = index.ranges(padded, np.array([len(p) for p in patterns]))
        found = sorted((int(a), int(b)) for x, y in index.locate(low, high) for a, b in zip(x, y, strict=True))
        assert found == sorted((i, j) for i, p in enumerate(patterns) for j in range(len(text) - len(p) + 1) if (text[j : j + len(p)] == p).all())


def plain_windows(text):
    w = re.findall(decontaminate.PATTERN, (text or "").translate(LOWER))
    return {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()


def plain_hits(items, bench):
    owners: dict[tuple, set] = {}
    for item, text in bench:
        for w in plain_windows(text):
            owners.setdefault(w, set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in items:
        w = re.findall(decontaminate.PATTERN, (text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in owners}:
            for i in range(len(w) - n + 1):
                if (own := owners.get(tuple(w[i : i + n]))) is not None:
                    found |= own
                    hit[i : i + n] = [True] * n
        out.append((doc_id, len(w), sum(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def leaked(spark):
    rng = random.Random(5)
    name = [f"w{i}" for i in range(30)] + ["é", "ünd", "x9"]
    bench = [(i, " ".join(rng.choice(name) for _ in range(rng.choice([1, 3, 9, 10, 11, 40])))) for i in range(25)] + [(None, "No id, HERE"), (3, "three again w1 w2"), (50, None), (51, "..."), (52, "")]
    docs = []
    for k in range(120):
        parts = [" ".join(rng.choice(name) for _ in range(rng.randrange(30))) for _ in range(3)]
        own = rng.choice(bench)[1] or ""
        docs.append((k, f"{parts[0]} {own.upper() if k % 3 else own[3:]}, {parts[1]}\n{rng.choice(bench)[1]} {parts[2]}"))
    docs += [(7, docs[7][1]), (None, docs[8][1]), (500, None), (501, "")]
    return docs, bench


@pytest.mark.parametrize("block_words,shard_rows", [(1 << 20, 100_000), (60, 11)])
def test_decontamination(spark, leaked, monkeypatch, block_words, shard_rows):
    docs, bench = leaked
    monkeypatch.setattr(decontaminate, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 5)
    held = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = rows(decontaminate.find_passages(held, items, block_words=block_words))
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["hit_items"]) for r in found), key=repr) == plain_hits(docs, bench)
    for r in found:  # spans are the hit words and lie apart
        inside = [w for s in r["hit_spans"] for w in re.findall(decontaminate.PATTERN, r["text"][s["start"] : s["end"]].translate(LOWER))]
        assert len(inside) == r["n_hit"] == sum(s["word_end"] - s["word"] for s in r["hit_spans"])
        assert all(a["word_end"] < b["word"] and a["end"] < b["start"] for a, b in zip(r["hit_spans"], r["hit_spans"][1:]))


def test_removal_leaves_the_rest(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Bevor é {item.title()}! after"), (2, "clean  text."), (3, item), (4, None)]
    held = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.remove_passages(held, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {1: "Bevor é ! after", 2: "clean  text.", 3: "", 4: None}


def test_decontamination_awkward(spark, awkward, empty):
    items = spark.createDataFrame([(1, "x.y@mail example"), (2, "one two three four")], "item_id long, text string")
    found = decontaminate.find_passages(awkward, items, ["doc_id", "at"])
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["hit_items"]) for r in rows(found)), key=repr) == plain_hits([(i, t) for i, t, *_ in AWKWARD], [(1, "x.y@mail example"), (2, "one two three four")])
    none = items.where("false")
    assert {(r["n_words"], r["n_hit"]) for r in rows(decontaminate.find_passages(awkward, none))} == {(n, 0) for _, n, *_ in plain_hits([(i, t) for i, t, *_ in AWKWARD], [])}
    assert decontaminate.find_passages(empty, items).count() == 0


# 13 -----------------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(items, fanout):
    """items: (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha(*map(field, r))

    def forged(r):
        change = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        return leaf((*r[:3], r[3] + 1, r[4])) if change else leaf(r)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
        return out

    parts = {}
    for r in items:
        parts.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), forged(r), r[0]))
    names = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([r[2] for r in sorted(parts[x], key=lambda r: r[:3])]) for x in names}
    top = levels([trees[x][-1][0] for x in names])
    out = []
    for k, x in enumerate(names):
        for place, r in enumerate(sorted(parts[x], key=lambda r: r[:3])):
            node, way = r[3], []
            for tree, at in ((trees[x], place), (top, k)):
                for level in tree[:-1]:
                    run = at - at % fanout
                    before, after = level[run:at], level[at + 1 : run + fanout]
                    way += before + after
                    node = sha(*before, node, *after)
                    at //= fanout
            out.append((r[4], r[2], trees[x][-1][0], top[-1][0], sha(*way), node, node == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes,fanout,depth", [((1,), 2, 4), ((2, 1, 3), 2, 4), ((16, 17, 33, 300, 0, 5), 2, 4), ((40, 9, 10, 28), 3, 2), ((7, 64), 2, 1)])
def test_manifest(spark, monkeypatch, sizes, fanout, depth):
    monkeypatch.setattr(merkle, "PIECE_ROWS", 40)
    monkeypatch.setattr(merkle, "EQUAL_ROWS", 2)
    names = [None, "", "é", "en", "de", "fr"]
    items = [(i * 7 + k, f"s{i % 3}" if i % 5 else None, names[k], i if i % 4 else None, f"téxt {i}" if i % 6 else None) for k, n in enumerate(sizes) for i in range(n)]
    items += items[:3] + items[:1] * 5 + [(None, None, names[0], None, None)] * 2
    df = spark.createDataFrame(items, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = merkle.manifest(df, merkle.tampered_chars(), fanout, depth)
    assert sorted((tuple(r.values()) for r in rows(found)), key=repr) == plain_manifest(items, fanout)


def test_manifest_verifies_what_is_untouched(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert merkle.manifest(docs).where("verified").count() == docs.count()


def test_manifest_awkward(spark, awkward, empty):
    assert merkle.manifest(empty).count() == 0
    items = [(i, source, lang, None if text is None else len(text), text) for i, text, lang, source in AWKWARD]
    assert sorted((tuple(r.values()) for r in rows(merkle.manifest(awkward, merkle.tampered_chars()))), key=repr) == plain_manifest(items, 2)


@pytest.mark.parametrize("name", ["op11_collocations", "op12_decontaminate", "op13_merkle"])
def test_same_rows_as_sql(spark, name):
    import duckdb

    from framewright.llm import queries
    from tests.test_catalog import rows as plain

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    ours, theirs = queries.QUERIES[name](spark, DATA).toPandas(), con.sql(queries.ORACLE[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns) and plain(ours) == plain(theirs)
