"""The pipeline's stages against brute force, each on what the stage before it kept, on awkward tables."""

import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsheet.llm import toxicity_ftrl
from jobsheet.llm.tokens import default_tokenizer

WORDS = "the of and to in is that it was for on are as with his they at be this from".split()
BAD = "vile scum awful hateful nasty".split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, h long, row int"


def prose(rng, n, vocab=WORDS):
    return " ".join(rng.choice(vocab) + str(rng.randint(0, 40)) if vocab is WORDS else rng.choice(vocab) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(160):
        toxic = k % 4 == 0
        words = prose(rng, 60).split()
        if toxic:
            for at in range(0, 60, 3):
                words[at] = rng.choice(BAD)
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    base = prose(rng, 120).split()
    for k in range(200, 212):  # a group of near copies
        near = list(base)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(120)] = f"other{rng.randint(0, 9999)}"
        rows.append((k, " ".join(near)))
    passage = prose(rng, 30)
    rows += [(300, prose(rng, 40) + " " + passage + " " + prose(rng, 20)), (301, passage), (302, None), (303, ""), (304, " \n"), (305, "Write to bo.42@mail8.example.com or 42.144.35.254 " + prose(rng, 50)),
             (306, prose(rng, 5000)), (1, rows[1][1]), (1, rows[1][1]), (None, prose(rng, 55)), (307, rows[2][1])]
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 5, 6) for i, t in rows], COLUMNS)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, passage), (1, None), (2, ""), (0, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def classes(texts):
    """Brute force: (text -> least index of its class) by five-word shingles at 0.8."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").lower())
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(texts)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) if sets[i] else None for i in range(len(sets))]


def test_stages(spark, tables):
    import corpus_pipeline
    from tokenizers import Tokenizer

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs, kept = spark.read.parquet(f"{tables}/documents.parquet"), [spark.read.parquet(f"{tables}/documents.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns and out.schema == docs.schema
        path = os.path.join(tables, "..", f"{os.path.basename(tables)}-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tables).collect()
    source, clean, single, plain, private = kept

    bad = [r for r in source if r.text and any(b in r.text for b in BAD)]
    left = {r.doc_id for r in clean}
    assert len([r for r in bad if r.doc_id not in left]) >= 0.9 * len(bad) and all(r in clean for r in source if r not in bad)

    order = sorted(clean, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    roots = classes([r.text for r in order])
    groups = {}
    for r, root in zip(order, roots):
        if root is not None:
            groups.setdefault(root, []).append(r)
    assert sorted(r.text for r in single if (r.text or "").strip()) and len([r for r in single if (r.text or "").strip()]) == len(groups)
    for members in groups.values():
        assert len([r for r in single if r in members]) == 1
    assert len([r for r in single if not (r.text or "").strip()]) == len([r for r in clean if not (r.text or "").strip()])

    assert {r.doc_id for r in single} - {r.doc_id for r in plain} == {300, 301}

    changed = {r.doc_id for r, s in zip(sorted(plain, key=lambda r: str(r.doc_id)), sorted(private, key=lambda r: str(r.doc_id))) if r.text != s.text}
    assert changed == {305} and all("bo.42" not in (r.text or "") and "42.144" not in (r.text or "") for r in private) and len(private) == len(plain)

    tok = Tokenizer.from_file(default_tokenizer())
    want = {}
    for r in private:
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            piece = np.array(ids[k:k + 2048], "<u4")
            want[r.doc_id, k // 2048] = (k, len(piece), zlib.crc32(piece.tobytes()))
    assert {(p.doc_id, p.piece): (p.start, p.length, p.ids_crc32) for p in packed} == want
    bins = {}
    for p in packed:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(map(tuple, corpus_pipeline.run(spark, tables).select("doc_id", "piece", "length").collect()), key=str) == sorted(((p.doc_id, p.piece, p.length) for p in packed), key=str)


def test_stages_of_an_empty_table(spark, tables):
    import corpus_pipeline

    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        assert out.count() == 0
        docs = docs if name != "packing" else out


def test_ftrl_equals_the_loop_over_coordinates():
    rng = np.random.default_rng(5)
    model = toxicity_ftrl.Ftrl(alpha=0.2, beta=0.7, l1=0.4, l2=0.3)
    z, n = {}, {}
    bias = 1 << toxicity_ftrl.BITS
    for _ in range(300):
        i = np.append(np.unique(rng.integers(0, 60, rng.integers(1, 12))), bias)
        y = int(rng.integers(0, 2)) if i[0] > 20 else 1
        w = {}
        for k in i.tolist():
            a, l1 = z.get(k, 0.0), 0.0 if k == bias else 0.4
            w[k] = 0.0 if abs(a) <= l1 else -(a - np.sign(a) * l1) / ((0.7 + n.get(k, 0.0) ** 0.5) / 0.2 + 0.3)
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for k in i.tolist():
            sigma = ((n.get(k, 0.0) + g * g) ** 0.5 - n.get(k, 0.0) ** 0.5) / 0.2
            z[k] = z.get(k, 0.0) + g - sigma * w[k]
            n[k] = n.get(k, 0.0) + g * g
        model.learn(i, y)
    for k in z:
        assert abs(model.z[k] - z[k]) < 1e-9 and abs(model.n[k] - n[k]) < 1e-9
    kept, _ = model.sparse()
    assert set(kept.tolist()) == {k for k in z if abs(z[k]) > 0.4 or k == bias}
