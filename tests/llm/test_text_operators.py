"""Brute-force versions of the operators that SQL can't express, and edge cases of all."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadastra.llm import anchors
from cadastra.llm.decontamination import contaminated
from cadastra.llm.language_id import identify_languages
from cadastra.llm.mixing import mix, word_count
from cadastra.llm.ngram_join import Lists, ngram_components
from cadastra.llm.quality_model import quality_scores
from cadastra.llm.quality_rules import quality_rules
from cadastra.llm.secret_scan import findings, read_ledger, redact, secret_scan, span_text, update_ledger
from cadastra.llm.substring_dedup import COVER, PERIOD, is_cover, substring_dedup
from cadastra.llm.suffix_dedup import suffix_dedup
from cadastra.llm.url_filter import RULES, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "   \n\t ", "one", "a b c d", "é ü 東京 😀 ñ", "x" * 50_000, "word " * 3000]


def corpus(seed: int, n: int = 60) -> list[tuple[int, str | None]]:
    """Random texts, near and exact copies, shared passages, odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "Ä", "zz."]
    passage = " ".join(rng.choices(words, k=70))
    rows: list[str | None] = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.35 or not rows or not rows[-1]:
            text = " ".join(rng.choices(words, k=rng.randint(1, 160)))
        elif kind < 0.55:
            text = rng.choice([r for r in rows if r])
        elif kind < 0.85:
            w = rng.choice([r for r in rows if r]).split(" ")
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            text = " ".join(w)
        else:
            text = " ".join(rng.choices(words, k=30)) + " " + passage + "\n" + " ".join(rng.choices(words, k=rng.randint(0, 40)))
        rows.append(text)
    rows += ODD
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def brute_components(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def brute_substrings(rows, window):
    first, words = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        words[d] = WORD.findall(t or "")
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out[d] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    return out


def brute_bytes(rows, length):
    data = {d: (t or "").encode() for d, t in rows}
    count = collections.Counter(t[i : i + length] for t in data.values() for i in range(len(t) - length + 1))
    out = {}
    for d, t in data.items():
        edge = [0] * (len(t) + length + 1)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone, depth = [], 0
        for i in range(len(t)):
            depth += edge[i]
            gone.append(depth > 0)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(frame(spark, rows)).collect()}
    assert found == brute_components(rows)


@pytest.mark.parametrize("limit", [1, 3])
def test_dealt_lists_lose_no_link(spark, limit):
    """Lists of more than `limit` sets are dealt over several parts."""
    rows = corpus(6)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(frame(spark, rows), list_limit=limit).collect()}
    assert found == brute_components(rows)


def test_rows_without_id_link_and_lend_no_id(spark):
    w = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(w[:40]), " ".join(w[1:41]), " ".join(w[2:42])
    rows = [(5, a), (None, b), (5, a), (7, c), (None, "x y z"), (None, "x y z"), (8, None), (None, None)]
    docs = frame(spark, rows).withColumns({"sig": F.lit("clash"), "n": F.lit(1), "id": F.lit(9)})
    out = sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in ngram_components(docs).collect()), key=str)
    assert out == sorted([(5, 36, 5), (5, 36, 5), (None, 36, 5), (7, 36, 5), (None, 1, None), (None, 1, None), (8, 0, 8), (None, 0, None)], key=str)


def test_occurrence_search_equals_plain_counting():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(80)]
    sets += [np.delete(s, rng.integers(0, len(s))) for s in sets if len(s) > 8]
    lists = Lists(sets)
    for s in sets:
        plain = [j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 75 * len(np.union1d(s, t))]
        assert lists.partners(s).tolist() == plain


def test_chain_of_near_copies_is_one_component(spark):
    """Neighbours in a chain link, its ends don't, and no leader links with all."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 8 : i * 8 + 120])) for i in range(30)]
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(frame(spark, rows)).collect()}
    assert found == brute_components(rows)
    assert {c for _, c in found.values()} == {0}


@pytest.mark.parametrize("seed", [3, 4])
def test_substring_dedup_equals_brute_force(spark, seed):
    rows = corpus(seed)
    found = {r["id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup(frame(spark, rows)).collect()}
    assert found == brute_substrings(rows, 50)


def test_difference_cover():
    assert is_cover(COVER, PERIOD)
    assert not is_cover((0, 1), 7)


@pytest.mark.parametrize("most", [20_000, 1])
def test_suffix_dedup_equals_brute_force(spark, most):
    """With most_segments 1 every bucket is divided down to single windows."""
    rows = corpus(5, 40)
    found = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup(frame(spark, rows), most_segments=most).collect()}
    assert found == brute_bytes(rows, 200)


@pytest.mark.parametrize("most", [20_000, 40])
def test_a_passage_in_most_texts(spark, most):
    """One bucket far above the bound, of different segments, is divided and sorted; tasks combine a hot anchor."""
    rng = random.Random(12)
    word = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage = word(60)
    rows = [(i, f"{word(rng.randint(0, 40))} {passage} {word(rng.randint(0, 40))}") for i in range(120)] + [(200, passage), (201, None), (202, word(30))]
    docs = frame(spark, rows)
    found = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup(docs, most_segments=most).collect()}
    assert found == brute_bytes(rows, 200)
    if most == 40:
        assert {r["id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup(docs).collect()} == brute_substrings(rows, 50)


@pytest.mark.parametrize("rule", [anchors.TEXTS, anchors.PLACES, anchors.LATER])
def test_combined_postings_equal_plain_grouping(spark, rule, monkeypatch):
    monkeypatch.setattr(anchors, "FLUSH", 50)
    rng = np.random.default_rng(3)
    h, owner, pos = rng.integers(0, 90, 700).astype(np.uint64), rng.integers(0, 40, 700), rng.integers(0, 5, 700)
    rank = owner // 2
    batches = anchors.combined([(h[a : a + 20], owner[a : a + 20], pos[a : a + 20], rank[a : a + 20]) for a in range(0, 700, 20)], 3, rule)
    packed = spark.createDataFrame(pa.Table.from_batches(list(batches)))
    found = {(r["owner"], p) for r in anchors.found_in(packed, 3, rule).collect() for p in anchors.positions(r["pos"]).tolist()}
    by = collections.defaultdict(set)
    for x in zip(h.tolist(), owner.tolist(), pos.tolist(), rank.tolist(), strict=True):
        by[x[0]].add(x[1:])
    plain = set()
    for g in by.values():
        if rule == anchors.LATER:
            plain |= {x[:2] for x in g if x[2] > min(y[2] for y in g)}
        elif len(g) > 1 if rule == anchors.PLACES else len({x[0] for x in g}) > 1:
            plain |= {x[:2] for x in g}
    assert found == plain


def test_repeated_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, text + " end"), (None, text), (2, "short")]
    out = sorted(((r["id"], r["n_removed"]) for r in substring_dedup(frame(spark, rows)).collect()), key=str)
    assert out == sorted([(1, 0), (1, 0), (1, 0), (None, 60), (2, 0)], key=str)
    assert sorted(r["n_removed"] for r in suffix_dedup(frame(spark, rows)).collect()) == sorted([0, *[len(text)] * 4])
    empty = frame(spark, [])
    for f in (ngram_components, substring_dedup, suffix_dedup, quality_rules, secret_scan, identify_languages):
        assert f(empty.withColumn("lang", F.lit("en"))).count() == 0
    assert mix(spark.createDataFrame([], "key long, source string, size long")).count() == 0


def test_quality_rules(spark):
    rows = [(1, "a sound line of ten words that ends with a stop."), (2, "home | about | news | shop | help | login | one two\n" * 2), (3, None), (4, "a b c d e " * 5), (5, ""), (6, "LOUD!! NOISE!! HERE!! NOW!! BUY!! THIS!! ONE!! AND!! THAT!! TOO!!")]
    docs = frame(spark, rows).withColumns({"n_words": F.lit("clash"), "kept": F.lit(0)})
    out = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert {d for d, r in out.items() if r["kept"]} == {1}
    assert not out[6]["base_failed"] and out[3]["base_failed"] and out[5]["base_failed"]
    left = {r["doc_id"]: r["text"] for r in quality_rules(frame(spark, [*rows, (7, "one\n\nclick here now\ntwo\n")]), remove=True).collect()}
    assert left == {1: rows[0][1], 2: "", 3: None, 4: rows[3][1], 5: "", 6: "", 7: "one\n\ntwo\n"}
    assert out[2]["n_dup_lines"] == 1 and out[4]["n_repeat_words"] == 25 and out[1]["n_words"] == 11


def test_secret_ledger_is_incremental(spark, tmp_path):
    key = "AKIA" + "ABCDEFGH12345678"
    rows = [(1, f"x {key} y"), (2, f"é😀 password = 'abcdefgh9'"), (3, None), (4, f"x {key} y"), (5, "token: short"), (6, "a" * 32 + " " + "f" * 31)]
    ledger = f"file://{tmp_path}/ledger"
    docs = frame(spark, rows).withColumn("spans", F.lit("clash"))
    update_ledger(docs, ledger)
    n = read_ledger(spark, ledger).count()
    assert n == 5 * 3  # four different texts and the empty one
    update_ledger(docs, ledger)
    assert read_ledger(spark, ledger).count() == n
    update_ledger(frame(spark, [(7, f"new {key}"), (8, None)]), ledger)
    assert read_ledger(spark, ledger).count() == n + 3
    out = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["t"], r["red"]) for r in findings(docs, ledger).withColumns({"t": span_text(F.col("spans")), "red": redact(F.col("text"), F.col("spans"))}).collect()}
    assert out[1] == out[4] == (0, 1, 0, "access:2:22", "x <secret> y")
    assert out[2] == (1, 0, 0, "assign:3:24", "é😀 <secret>'")
    assert out[3][:4] == (0, 0, 0, "") and out[5][:4] == (0, 0, 0, "")
    assert out[6][:4] == (0, 0, 1, "hex:0:32")


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 400)) for i in range(3000)] + [(3000, "c", 0)]
    docs = spark.createDataFrame(rows, "key long, source string, size long")
    out = mix(docs.repartition(5), bucket_rows=64, fan_in=4).collect()
    assert sorted(r["key"] for r in out) == list(range(3001))
    assert sorted(mix(docs.repartition(2), bucket_rows=64, fan_in=4).collect()) == sorted(out)  # reruns agree, however rows are dealt
    sizes = collections.Counter()
    for _, s, n in rows:
        sizes[s] += n
    order = sorted((s for s in sizes if s), key=lambda s: s) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, goal = {}, [s for s in order if sizes[s]], 1.5 * sum(sizes.values())
    target = {s: 0.0 for s in order}
    while True:
        level = goal / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s] + 1e-9]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            goal -= target[s]
            open_.remove(s)
    for s in open_:
        target[s] = level * weight[s]
    for s in order:
        mine = [r for r in out if r["source"] == s]
        assert all(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= 400
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in mine)
    words = frame(spark, list(enumerate(ODD))).select("doc_id", word_count(F.col("text")).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in words} == {i: len(WORD.findall(t or "")) for i, t in enumerate(ODD)}


def test_decontamination(spark):
    item = "A farmer has 12 apples and Maria takes 5 of them so how many apples remain in the old basket"
    other = item.replace("12", "31").replace("5", "9").replace("Maria", "Otto")
    mixed = "A farmer has 12 apples and Maria takes 12 of them so how many apples remain in the old basket"
    items = spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")
    rows = [(1, f"Before.  {item}, after"), (2, f"We ask:\n{other}"), (3, mixed), (4, "nothing of the kind is said in this text at all, believe it or not"), (5, None), (6, ""), (10, f"{item} {item}")]
    out = {(r["id"], r["item_id"]) for r in contaminated(frame(spark, rows).withColumn("item_id", F.lit(0)), items).collect()}
    assert out == {(1, 7), (2, 7), (10, 7)}
    assert contaminated(frame(spark, rows), items.limit(0)).count() == 0
    assert contaminated(frame(spark, []), items).count() == 0


def test_decontamination_in_any_surroundings(spark):
    items = {
        1: "What is the boiling point of water?", 2: "Tom has 5 apples. Ann eats 3 apples. Bob buys 9 pears.", 3: "Who wrote Hamlet?", 4: "12 + 7 = 19 and 30 + 41 = 71", 5: "...",
        6: "The Old farmer sold a brown horse to Maria for 12 coins",
    }
    rows = [
        (1, "A heading\nWhat is the boiling point of water? It is known", {1}), (2, "they ask what is the BOILING point of water", {1}), (3, "Joe has 7 apples. Eve eats 2 apples. Max buys 4 pears.", {2}),
        (4, "so tom has 6 apples. ann eats 2 apples. bob buys 8 pears, they say", {2}), (5, "It was asked: who wrote hamlet", {3}), (6, "who wrote it? Hamlet", set()), (7, "(12 + 7 = 19 and 30 + 41 = 71)", {4}),
        (8, "12 + 7 = 18 and 30 + 41 = 71", set()), (9, "... - ...", set()), (10, "Then the Old farmer sold a brown horse to Otto for 15 coins", {6}),
    ]
    known = spark.createDataFrame([*items.items()], "item_id long, text string")
    out = contaminated(frame(spark, [r[:2] for r in rows]), known).collect()
    assert {(r["id"], r["item_id"]) for r in out} == {(d, i) for d, _, found in rows for i in found}


def test_decontamination_with_clashing_values(spark):
    long_ = "In spring the 3 gardeners plant 40 tulips along the narrow path and water them for 2 hours before they go back to the 5 sheds where 17 wooden tools hang on the wall"
    items = {
        1: "A train needs 1 hour to the coast and the bus needs 3 hours for it", 2: "She bought 3 pens and then also 3 books so how many things were there",
        3: "He counts 12 sheep in one field and 7 goats in another so how many animals", 4: long_, 5: "Two friends called Tom and Ann share the apples that they found there",
    }
    rows = [
        (1, "A train needs 2 hours to the coast and the bus needs 3 hours for it", {1}), (2, "She bought 4 pens and then also 7 books so how many things were there", {2}),
        (3, "He counts 5 sheep in one field and 5 goats in another so how many animals", {3}), (4, long_.replace("17", "40"), {4}),
        (5, "Two friends called Bob and Bob share the apples that they found there", set()),
    ]
    known = spark.createDataFrame([*items.items()], "item_id long, text string")
    out = contaminated(frame(spark, [r[:2] for r in rows]), known).collect()
    assert {(r["id"], r["item_id"]) for r in out} == {(d, i) for d, _, found in rows for i in found}


def test_url_filter(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    urls = {
        "http://A.Example.com/en/71?x": ("a.example.com", "/en/71", "example.com/en/7", "allow"), "https://x.com/en/": ("x.com", "/en/", "com/en/", "block"),
        "http://com/en": ("com", "/en", None, "allow"), "http://excom/en/7": ("excom", "/en/7", None, "allow"), "x.com/en/": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
        "http://example.net/de/8#a://b/c": ("example.net", "/de/8", "example.net/de/8", "block"), "http://example.org?q=/es/": ("example.org", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*urls, *urls])], "page_id long, url string, verdict string")
    out = url_filter(pages, rules).collect()
    assert len(out) == 2 * len(urls)
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == urls[r["url"]]
    assert {r["verdict"] for r in url_filter(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter(pages.limit(0), rules).count() == 0


def test_url_rules_as_dealt(spark):
    """Each rule of the contract by itself, with its own word."""
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    dealt = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    out = url_filter(spark.createDataFrame([("http://" + r,) for r in dealt], "url string"), rules).collect()
    assert {r["rule"]: r["verdict"] for r in out} == dealt == {h + p: a for h, p, a in RULES}


def test_models_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(900_000 + i, t) for i, t in enumerate([*ODD, "123 456", "東京"])], "doc_id long, text string")
    both = docs.select("doc_id", "text", "lang").unionByName(odd.withColumn("lang", F.lit(None).cast("string")))
    out = {r["id"]: r for r in identify_languages(both).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in out.items())
    held = [d for d in truth if out[d]["held_out"]]
    assert sum(out[d]["lang_pred"] == truth[d] for d in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert [out[900_000 + i]["lang_pred"] == "und" for i in (0, 1, 2, 8)] == [True] * 4 and out[900_009]["lang_pred"] != "und"
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scores = {r["id"]: r for r in quality_scores(both, labels).collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if scores[r["doc_id"]]["held_out"]}
    assert sum(scores[d]["predicted"] == q for d, q in known.items()) >= 0.9 * len(known)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scores.values()) and len(scores) == len(out)
    assert {r["score"] for r in quality_scores(odd, labels.limit(0)).collect()} == {0.5}
