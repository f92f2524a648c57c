"""Near duplicates of every small size, sites that only share a suffix, whole names, and many languages."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from framewright.llm import jaccard, langid, links, surrogates
from tests.llm.test_llm import rows


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_small_sets_lose_no_link(spark):
    """Sets of 1 to 12 shingles, and more: a word appended, put in front or changed at the end; every link at the threshold or above is found."""
    rng = random.Random(2)
    texts, pairs = [], []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    for n in [*range(1, 17), 20, 24, 30]:
        for _ in range(6):
            own = [word() for _ in range(n)]
            for other in (own + [word()], [word()] + own, own[:-1] + [word()], own + [word(), word()]):
                a, b = shingles(own), shingles(other)
                if 5 * len(a & b) >= 4 * len(a | b):
                    pairs.append((len(texts), len(texts) + 1))
                texts += [" ".join(own), " ".join(other)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["class_id"] for r in rows(jaccard.near_duplicates(df))}
    assert len(pairs) > 150 and [p for p in pairs if found[p[0]] != found[p[1]]] == []


def test_partners_share_a_prefix():
    for n in range(1, 150):
        for m in range(n, n * 5 // 4 + 1):
            assert min(jaccard.depths(n)[-1], jaccard.depths(m)[-1]) in set(jaccard.depths(n)) & set(jaccard.depths(m)), (n, m)


def test_sites_end_below_the_suffix(spark):
    chain = lambda h: spark.createDataFrame([(h,)], "h string").select(links.site_chain(F.col("h"))).first()[0]
    assert chain("a.b.example.net") == ["a.b.example.net", "b.example.net", "example.net"] and chain("example.net") == ["example.net"]
    assert chain("x.shop.co.uk") == ["x.shop.co.uk", "shop.co.uk"] and chain("localhost") == ["localhost"]
    assert chain("10.0.0.1") == ["10.0.0.1"] and chain("a.b.c:8080") == ["a.b.c:8080"] and chain("[::1]") == ["[::1]"]


def test_hosts_under_one_suffix_are_strangers(spark):
    pages = [(1, "http://a.evil.net/es/1", ""), (2, "http://unrelated.net/foo", ""), (3, "http://other-shop.net/bar", None), (4, "http://b.evil.net/x", ""), (5, "http://10.0.0.1:8080/es/", ""), (6, "http://10.0.0.2:8080/", "")]
    out = {r["page_id"]: r for r in rows(links.judge_pages(spark.createDataFrame(pages, "page_id long, url string, html string")))}
    assert {i: out[i]["verdict"] for i in out} == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow"}
    assert out[2]["distrust"] is None or out[2]["distrust"] == 0


NAMES = [
    ("Mr John Paul Smith wrote", ["John", "Paul", "Smith"]), ("saw Mr Smith-Jones today", ["Smith", "Jones"]), ("Mrs O'Brien and", ["Brien"]), ("Monsieur D’Arcy, who", ["Arcy"]),
    ("Mr. van Beethoven played", ["Beethoven"]), ("Dr. Anna Lee said", ["Anna", "Lee"]), ("Mr John de la Cruz Gómez is", ["John", "Cruz", "Gómez"]), ("FRAU MARIA  MÜLLER rief", ["MARIA", "MÜLLER"]), ("Herr J. K. Kessler ging", ["Kessler"]),
]
TOKENS = ["github_pat_" + "a1B2" * 6, "xoxb-" + "12ab" * 5, "AIza" + "Sy9_" * 6, "eyJhbGciOi.eyJzdWIiOi.SflKxwRJSM", "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"]


def test_names_are_replaced_whole(spark):
    items = [(i, text) for i, (text, _) in enumerate(NAMES)] + [(100, "MR JOHN SMITH and later John Smith, but not Johnson"), (101, "Mr A said"), (102, "Mr said nothing")]
    out = {r["doc_id"]: r["text"] for r in rows(surrogates.replace_entities(spark.createDataFrame(items, "doc_id long, text string"), "k"))}
    for i, (text, names) in enumerate(NAMES):
        assert not [n for n in names if re.search(rf"(?<!\w){n}(?!\w)", out[i])], (text, out[i])
        assert out[i].split()[-1] == text.split()[-1] and len(out[i].split()) == len(text.split()), (text, out[i])
    assert " van " in out[4] and " de la " in out[6] and out[7].split()[1].isupper()
    upper, last, first, again = re.match(r"MR (\S+) (\S+) and later (\S+) (\S+), but not Johnson$", out[100]).groups()
    assert (upper, last) == (first.upper(), again.upper()) and first.istitle() and "SMITH" != last
    assert out[101] == "Mr A said" and out[102] == "Mr said nothing"


def test_tokens_and_accounts(spark):
    items = [(i, f"key {x} end") for i, x in enumerate(TOKENS)] + [(50, "DE89370400440532013000"), (51, "WORD AB12 TEXT ONLY HERE")]
    out = {r["doc_id"]: r["text"] for r in rows(surrogates.replace_entities(spark.createDataFrame(items, "doc_id long, text string"), "k"))}
    for i, x in enumerate(TOKENS):
        got = out[i][4:-4]
        start = re.match(r"github_pat_|xoxb-|AIza|eyJ|[A-Z]{2}", x)[0]
        assert got != x and got.startswith(start) and [c.isdigit() for c in got] == [c.isdigit() for c in x] and len(got) == len(x), (x, got)
    assert out[50] == out[4][4:-4].replace(" ", "") and out[51] == "WORD AB12 TEXT ONLY HERE"


def test_helper_columns_do_not_clash(spark):
    clash = ("__found", "__new", "__whole", "__names", "__special", "__named", "m_row", "m_special")
    df = spark.createDataFrame([(1, "Mr John Smith, John Smith")], "doc_id long, text string").select("*", *[F.lit(7).alias(c) for c in clash])
    out = surrogates.replace_entities(df, "k")
    assert set(out.columns) == {*df.columns, "n_entities"} and "Smith" not in out.first()["text"] and all(out.first()[c] == 7 for c in clash)


def test_all_of_many_languages_can_be_predicted(spark):
    rng = random.Random(4)
    labels = [f"l{i:03d}" for i in range(230)]
    word = {x: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(6)] for x in labels}
    texts = [(i, " ".join(rng.choice(word[x]) for _ in range(40)), x) for i, x in enumerate(labels * 5)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model.langs == labels
    right = [model.predict(" ".join(word[x] * 5))[0] == x for x in labels]
    assert sum(right) >= 0.9 * len(right)


@pytest.mark.parametrize("text", ["der Hund und die Katze", "x", "日本 12"])
def test_scores_equal_a_plain_softmax(text):
    """The product of embeddings and linear layer gives what n-gram counts, a mean and a softmax give one by one."""
    model = langid.train([("the dog and the cat " * 3, "en"), ("der Hund und die Katze " * 3, "de")] * 8)
    counts: dict[int, int] = {}
    raw = f" {text.lower()} ".encode()
    for k in (2, 3, 4):
        for i in range(len(raw) - k + 1):
            g = raw[i]
            for c, (a, b) in zip(raw[i + 1 : i + k], [(0x9E3779B1, 0x85EBCA77), (0xC2B2AE3D, 0x27D4EB2F), (0x165667B1, 0x9E3779B1)]):
                g = (g * a + c * b) & 0xFFFFFFFF
            mixed = ((g ^ (g >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
            bucket = mixed >> (32 - langid.BUCKETS.bit_length() + 1)
            counts[bucket] = counts.get(bucket, 0) + 1
    n = sum(counts.values())
    logits = [(sum(c * float(model.table[b][j]) for b, c in counts.items()) / n + float(model.bias[j])) / model.temperature for j in range(len(model.langs))]
    top = max(logits)
    e = [math.exp(x - top) for x in logits]
    p = [x / sum(e) for x in e]
    lang, score = model.predict(text)
    assert lang == model.langs[p.index(max(p))] and score == pytest.approx(max(p), rel=1e-4)
