"""Each stage of the pipeline against a plain version of it, on its own input."""

import re

import pytest

import corpus_pipeline

from .test_text_operators import WORD, brute_components

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def kept_by_rules(text: str | None) -> bool:
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {x for x in windows if windows.count(x) > 1}
    repeated = {j for i, x in enumerate(windows) if x in twice for j in range(i, i + 5)}
    if len(w) < 10 or 100 * len(repeated) > 20 * len(w):
        return False
    lost = 0
    for line in (text or "").split("\n"):
        words = WORD.findall(line)
        loud = sum(bool(re.search(r"([!?]{2}|[#*$%&])$", x)) for x in words)
        menu = sum(bool(re.fullmatch(r"[|<>«»·•/]+", x)) for x in words)
        plate = any(p in line.lower() for p in corpus_pipeline.rules.PHRASES)
        if words and ((loud >= 3 and 10 * loud >= 3 * len(words)) or (menu >= 3 and 5 * menu >= len(words)) or plate):
            lost += len(words)
    return 2 * lost <= len(w)


def without_secrets(text: str) -> str:
    spans = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16] + [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    out, at = "", 0
    for a, b in sorted(spans):
        if a >= at:
            out += text[at:a] + "<secret>"
        at = max(at, b)
    return out + text[at:]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before each stage and after the last one."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        seen.append({r["doc_id"]: r.asDict() for r in docs.collect()})
        docs = corpus_pipeline.cut(stage(spark, docs, SF), f"test-{name}")
    return [*seen, {r["doc_id"]: r.asDict() for r in docs.collect()}]


def test_columns_stay_those_of_documents(stages):
    for rows in stages[1:5]:
        assert {tuple(r) for r in rows.values()} == {("doc_id", "text", "lang", "source", "n_chars")}


def test_quality_rules(stages):
    assert set(stages[1]) == {d for d, r in stages[0].items() if kept_by_rules(r["text"])}


def test_one_document_of_each_group_stays(stages):
    groups = brute_components([(d, r["text"]) for d, r in stages[1].items()])
    assert set(stages[2]) == {d for d, (_, c) in groups.items() if c == d}


def test_benchmark_passages_go(spark, stages):
    plain = lambda t: [re.sub(r"[!-/:-@\[-`{-~]", "", w).lower() for w in WORD.findall(t or "")]
    windows = {tuple(w[i : i + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in [plain(r["text"])] for i in range(len(w) - 9)}
    dirty = {d for d, r in stages[2].items() for w in [plain(r["text"])] if any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))}
    assert set(stages[3]) == set(stages[2]) - dirty


def test_secrets_are_replaced(stages):
    assert {d: (r["text"], r["n_chars"]) for d, r in stages[4].items()} == {d: (t := without_secrets(r["text"]), len(t)) for d, r in stages[3].items()}


def test_mix_comes_near_its_targets(stages):
    rows, mixed = stages[4], stages[5]
    size = {d: len(WORD.findall(r["text"])) for d, r in rows.items()}
    assert all(r["size"] == size[d] and r["taken"] == r["copies"] * r["size"] > 0 and r["copies"] <= 2 for d, r in mixed.items())
    for source in {r["source"] for r in rows.values()}:
        mine = [d for d, r in rows.items() if r["source"] == source]
        target = {mixed[d]["target"] for d in mine if d in mixed}
        taken = sum(mixed[d]["taken"] for d in mine if d in mixed)
        assert len(target) <= 1 and all(abs(taken - t) <= max(size[d] for d in mine) for t in target)


def test_repeated_and_null_ids(spark):
    prose = lambda seed, n: " ".join(f"{chr(97 + seed)}{i * i % 97}x{i}" for i in range(n))
    texts = [(5, prose(0, 40)), (5, prose(0, 40)), (5, prose(1, 30)), (3, prose(1, 30)), (None, prose(2, 25)), (None, prose(3, 20)), (None, prose(2, 25)), (8, prose(4, 35)), (8, prose(5, 15)), (8, prose(4, 35))]
    docs = spark.createDataFrame([(d, t, "en", "ab"[k % 2], len(t)) for k, (d, t) in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.ngram_join(spark, docs, SF)
    known = sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect())
    assert known == sorted([(5, prose(0, 40)), (3, prose(1, 30)), (8, prose(4, 35)), (8, prose(5, 15))]) and kept.where("doc_id is null").count() == 3
    sizes = corpus_pipeline.mixer.targets(spark.createDataFrame([(s, sum(len(t.split()) for k, (_, t) in enumerate(texts) if "ab"[k % 2] == s)) for s in "ab"], "source string, source_size long"))
    mixed = corpus_pipeline.mixing(spark, docs.repartition(3), SF).collect()
    for source, target in ((r["source"], r["target"]) for r in sizes.collect()):
        mine = [r for r in mixed if r["source"] == source]
        assert len(mine) <= 5 and abs(sum(r["taken"] for r in mine) - target) <= 40 and all(r["target"] == target for r in mine)
    assert any(r["doc_id"] is None for r in mixed)
