"""The training-data operators against brute force on small inputs with the awkward rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsheet.llm import bestfit, crc32c, decontaminate, jaccard_join, line_frequency, quotes, records, suffix_dedup, surrogates, toxicity_ftrl, url_filter
from jobsheet.llm.tokens import default_tokenizer, encoder

WORDS = "the of and to in is that it was for on are as with his they at be this from".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = prose(rng, 300)
    words = base.split()
    out = [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, "  \n"), (None, "short one"), (6, "a" * 3000), (7, "ab " * 900)]
    for i in range(10, 40):  # near copies
        w = list(words)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = "x" + str(rng.random())
        out.append((i, " ".join(w)))
    passage = prose(rng, 120)
    out += [(i, prose(rng, 80) + " " + passage + " " + prose(rng, 40)) for i in range(50, 60)]
    out += [(60, prose(rng, 9000)), (61, "Ünï Straße 日本語 'S it's <|endoftext|> İ"), (62, "one two three")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    # extra columns with names that the operators use inside
    return spark.createDataFrame([(i, t, i, "h", "x") for i, t in rows], "doc_id long, text string, key long, h string, id string").repartition(3)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_encoder_is_the_librarys(rows):
    enc = encoder(default_tokenizer())
    for t in [t for _, t in rows] + ["aé\u0301 \x1c", "ÀÖØ ĲĿ—“q”", "'ll 12.5'd"]:
        want = enc.tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == want


def ids_of(text, end):
    enc = encoder(default_tokenizer())
    return np.array([*enc.tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_checksums():
    assert crc32c.crc32c([b"123456789"])[0] == 0xE3069283
    data = [random.Random(n).randbytes(n) for n in (0, 1, 3, 4, 1023, 1024, 5000)]
    assert [int(x) for x in crc32c.crc32c(data)] == [crc32c._short(d) for d in data]
    framed = records.frame([b"abc", b""])
    assert records.unframe(framed) == [b"abc", b""]
    with pytest.raises(records.BadRecord):
        records.unframe([framed[0][:13] + b"X" + framed[0][14:]])


def test_records(spark, docs, rows):
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in records.round_trip(spark, docs).collect()))
    start = 0
    assert [g[:2] for g in got] == sorted((i is not None, i or 0) for i, _ in rows)
    for _, i, s, n, crc in got:
        assert s == start
        start += n
    want = Counter((len(x), zlib.crc32(x.tobytes())) for x in (ids_of(t, 1) for _, t in rows))
    assert Counter(g[3:] for g in got) == want
    assert records.round_trip(spark, empty(spark)).count() == 0


def best_fit(items, capacity):
    bins = []
    for n in sorted(items, reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] >= n]
        b = min(fits, key=bins.__getitem__) if fits else len(bins)
        bins += [capacity] * (b == len(bins))
        bins[b] -= n
    return sorted(bins)


def test_best_fit_plan():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([7, 20, 64])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        plan, left = sorted(bestfit.best_fit_plan(Counter(items), capacity)), Counter()
        for n, c in Counter(items).items():
            for r in range(c):
                e = [x for x in plan if x[0] == n and x[1] <= r][-1]
                left[e[2] + (r - e[1]) // e[3]] += n
        assert sorted(capacity - v for v in left.values()) == best_fit(items, capacity)


def test_packing(spark, docs, rows):
    got = bestfit.pack(docs).toPandas()
    want = Counter()
    for _, t in rows:
        x = ids_of(t, 0)
        want.update((k // 2048, k, len(x[k:k + 2048]), zlib.crc32(x[k:k + 2048].tobytes())) for k in range(0, len(x), 2048))
    assert Counter(zip(got.piece, got.start, got.length, got.ids_crc32, strict=True)) == want
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.sequence_id.nunique() == len(best_fit(got.length.tolist(), 2048)) and got.groupby("sequence_id").length.sum().max() <= 2048
    assert bestfit.pack(empty(spark)).count() == 0


def shingle_set(t, k):
    import re
    w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def classes(rows, k, num, den):
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    return sorted(((i, len(s), least[r] if s else i) for (i, _), s, r in zip(rows, sets, root, strict=True)), key=str)


@pytest.mark.parametrize("limit", [1000, 5])  # all groups in one task; all by centre and blocks
def test_jaccard_join(spark, docs, rows, limit, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MAX_GROUP", limit)
    monkeypatch.setattr(jaccard_join, "BLOCK", min(limit, 500))
    got = sorted((tuple(r) for r in jaccard_join.join_classes(docs).collect()), key=str)
    assert got == classes(rows, 4, 85, 100)


def test_jaccard_stage(spark, docs, rows):
    got = jaccard_join.one_of_each(docs)
    assert got.columns == docs.columns
    n = len({(i, c) if not s else c for i, s, c in classes(rows, 5, 80, 100)})
    assert got.count() == n and jaccard_join.one_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("limit", [20_000, 3])
def test_suffix_dedup(spark, docs, rows, limit, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MAX_GROUP", limit)
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    want = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 399):
            if seen[t[s:s + 400]] > 1:
                gone[s:s + 400] = True
        want.append((str(i), len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)


def test_periodic_grams_do_not_depend_on_the_pack():
    passage = np.frombuffer((b"abcdefg" * 6)[:suffix_dedup.GRAM], np.uint8)
    noise = np.random.default_rng(3).integers(0, 256, 1 << 18).astype(np.uint8)
    alone, amid = suffix_dedup.gram_hashes(passage), suffix_dedup.gram_hashes(np.concatenate([noise, passage, noise]))
    assert alone[0] >> np.uint64(63) == 1 and amid[len(noise)] == alone[0]


def test_contamination(spark, docs, rows):
    tests = spark.createDataFrame([("a", " ".join(rows[0][1].split()[20:45])), ("b", "one TWO three"), ("c", None), ("d", "!!"), (None, "日本語")], "item_id string, text string")
    got = {(str(r.doc_id), r.n_hit > 0, tuple(r["items"])) for r in decontaminate.contamination(docs, tests).collect()}
    assert ("62", True, ("b",)) in got and ("61", True, ("",)) in got and ("3", False, ()) in got and ("1", True, ("a",)) in got
    one = {(r.doc_id, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(docs, tests, block_bytes=20).collect()}
    assert one == {(r.doc_id, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(docs, tests).collect()}
    kept = decontaminate.remove_contaminated(docs, tests)
    assert kept.columns == docs.columns and kept.count() == sum(not x for r in decontaminate.contamination(docs, tests).collect() for x in [r.contaminated])


def test_toxicity(spark):
    rng = random.Random(3)
    data = [(i, prose(rng, 40) + (" scoundrel" if i % 4 == 0 else "")) for i in range(600)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(5, None), (None, 1), (7777, 1)], "doc_id long, toxic int")
    fitted = toxicity_ftrl.train(docs, labels)
    got = toxicity_ftrl.score(docs, fitted).toPandas()
    held = got[got.held_out & (got.doc_id < 600)]
    assert len(held) > 50 and (held.predicted == (held.doc_id % 4 == 0)).mean() > 0.97 and got.score.between(0, 1).all()
    assert set(held.doc_id) == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert toxicity_ftrl.remove_toxic(docs, fitted).count() == (got.score < 0.5).sum()
    none = toxicity_ftrl.train(docs, labels.limit(0))
    assert toxicity_ftrl.score(docs, none).filter("predicted = 1").count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.com/en/1?x#y", "http://www.example.com/en/1", "x://net/es/", "http://a.net/fr/q", "http://evilcom/en/", "http://b.com", "http://c.org/de/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    ruled = url_filter.apply_rules(url_filter.parse(pages, "url")).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in ruled] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/1", "www.example.com/en/"),
        ("net", "/es/", "net/es/"), ("a.net", "/fr/q", "net/fr/"), ("evilcom", "/en/", None), ("b.com", "", None), ("c.org", "/de/1", None)]
    model = url_filter.fit(url_filter.labelled(url_filter.apply_rules(url_filter.parse(pages, "url"))))
    got = url_filter.judge(pages, model)
    assert got.count() == len(urls) and got.filter("verdict NOT IN ('allow', 'block') OR verdict IS NULL").count() == 0
    assert url_filter.judge(pages, url_filter.fit(url_filter.labelled(url_filter.apply_rules(url_filter.parse(pages.limit(0), "url"))))).filter("rule IS NULL AND verdict = 'block'").count() == 0


def test_url_labels_keep_their_shares(spark):
    urls = [f"http://a.com/{i}" for i in range(10)] + [f"http://a.net/es/{i}" for i in range(40)] + ["http://a.net/es/0"]
    ruled = url_filter.apply_rules(url_filter.parse(spark.createDataFrame([(u,) for u in urls], "url string"), "url"))
    for bound, taken in ((4, (4, 4)), (20, (10, 20)), (100, (10, 40))):
        got = url_filter.labelled(ruled, bound).groupBy("label").agg(F.count("*"), F.sum("weight")).orderBy("label").collect()
        assert [tuple(r) for r in got] == [(0.0, taken[0], 10.0), (1.0, taken[1], 40.0)]


def test_lines(spark):
    data = [(i, f"own line {i} of document number{chr(97 + i % 26)}{i} " + "w " * 60 + f"\nMenu  ITEM {i}\nfooter", "a" if i % 2 else None) for i in range(60)] + [(99, None, "a"), (100, "", "a"), (101, "menu item 7", "a")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in line_frequency.line_quality(docs, max_docs=5, max_share=0.1).collect()}
    assert len(got) == 63 and got[1].removed_words == 4 and got[2].removed_words == 4 and got[101].depleted and not got[99].kept
    assert line_frequency.repeated_words(np.array([1, 2, 3, 9, 1, 2, 3])) == 6 and line_frequency.repeated_words(np.array([1, 1, 1, 1])) == 4


def test_surrogates(spark):
    data = [(1, "Mail bo.42@mail8.example.com or BO.42@mail8.example.com, +1 (988) 555-2485, 4041894974608795, 42.144.35.254", "k"),
            (2, "Mr. John Smith, Frau Müller, Госпожа Анна Иванова, Mr. Smith; +1 988-555-2485; bo.42@mail8.example.com", "k"), (3, None, None), (4, "", ""), (5, "clean 4.0. text", "")]
    data += [(100 + i, f"{a}@x.yz", "") for i, a in enumerate("abcdefghijklmnopqrstuvwxyz" + "ABC")] + [(200, "aa@x.yz", "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, e string")
    got = {r.doc_id: r.text for r in surrogates.replace_personal_data(docs, "k'ey").collect()}
    assert got[3] is None and got[4] == "" and got[5] == "clean 4.0. text"
    for private in ("bo.42", "988", "4041894974608795", "42.144.35.254", "Smith", "Müller", "Анна"):
        assert not any(private in (t or "") for t in got.values())
    phone = got[1].split("+1 ")[1][:14]
    assert phone[0] == "(" and phone.replace("(", "").replace(") ", "-") in got[2]  # coreference across formats
    family = got[2].split(",")[0].split()[-1]
    assert f"Mr. {family};" in got[2]
    card = [int(c) for c in got[1].split(", ")[2]]
    assert len(card) == 16 and sum(sum(divmod(2 * d, 10)) if i % 2 == 0 else d for i, d in enumerate(card)) % 10 == 0
    assert len({got[i] for i in [*range(100, 126), 200]}) == 27  # more mailboxes than single letters: later attempts


def test_longest_verbatim_match(spark):
    rng = random.Random(9)
    w = [f"v{k}" for k in range(60)]
    items = [("a", " ".join(w[:14])), ("b", " ".join(w[8:20])), ("c", "short item here"), ("d", " ".join(w[30:60])), ("e", " ".join(w[30:60]))]
    docs = [(1, "x " + " ".join(w[:20]) + " y"),  # two items of 14 and 12 words that overlap
            (2, "so a short item here and " + " ".join(w[35:50])), (3, "nothing " + " ".join(w[:9])), (4, None), (5, " ".join(w[30:60]) + " z " + " ".join(w[30:60]))]
    want = {1: (14, 1, "a", 0), 2: (15, 6, "d", 5), 3: None, 4: None, 5: (30, 0, "d", 0)}
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    for size in (decontaminate.BLOCK_BYTES, 30):
        got = {r.doc_id: r.longest and tuple(r.longest) for r in decontaminate.contamination(d, b, block_bytes=size).collect()}
        assert got == want
    vocab = "one two three".split()  # many repeats: every common substring against brute force
    docs = [(k, " ".join(rng.choice(vocab) for _ in range(40))) for k in range(12)]
    items = [(str(k), " ".join(rng.choice(vocab) for _ in range(25))) for k in range(4)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: r.longest and tuple(r.longest) for r in decontaminate.contamination(d, b, window=4).collect()}
    for k, text in docs:
        x, best = text.split(), None
        for i, t in items:
            y = t.split()
            for p in range(len(x)):
                for q in range(len(y)):
                    n = 0
                    while p + n < len(x) and q + n < len(y) and x[p + n] == y[q + n]:
                        n += 1
                    if n >= 4:
                        best = min(best or (0,), (-n, p, i, q))
        assert got[k] == (best and (-best[0], *best[1:]))


def test_surrogates_keep_their_form(spark):
    data = [(1, "DE89370400440532013000 GB29 NWBK 6016 1331 9268 19"), (2, "Mr ANNA SMITH-JONES met Господин Иван-Петр Волков"), (3, "Ольга@почта.рф"),
            (4, "x@" + "a." * 20_000), (5, "password=" + "x" * 30_000)]
    got = {r.doc_id: r.text for r in surrogates.replace_personal_data(spark.createDataFrame(data, "doc_id long, text string"), "key").collect()}

    def mod97(iban):
        return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97
    assert mod97(got[1][:22]) == 1 and mod97(got[1][23:].replace(" ", "")) == 1 and got[1].startswith("DE") and got[1][23:].startswith("GB")
    latin, cyrillic = got[2].split(" met ")
    assert latin.split()[1:] == latin.upper().split()[1:] and latin.count("-") == 1 and cyrillic.split()[1].count("-") == 1
    assert not any("a" <= c.lower() <= "z" for c in cyrillic + got[3]) and got[3].endswith(".рф") and "Ольга" not in got[3]
    assert len(got[4]) == len(data[3][1]) and len(got[5]) == len(data[4][1]) and "xxx" not in got[5]


def test_quotes_of_very_many_marks(spark):
    data = [(1, 0, "u", "hello there"), (1, 1, "a", ">" * 30_000 + " deep"), (1, 2, "a", "> >  > hello there\nfine")]
    got = {r.turn: r for r in quotes.link(spark.createDataFrame(data, "conv_id long, turn int, role string, text string")).collect()}
    assert got[1].max_level == 30_000 and got[1].text == "" and (got[2].max_level, got[2].parent_turn, got[2].text) == (3, 0, "fine")


def test_one_of_each_keeps_columns_of_any_name(spark):
    rng = random.Random(3)
    a, b = prose(rng, 80), prose(rng, 80)
    rows = [(1, a, 7, 8, 9), (2, a + " x", 7, 8, 9), (3, b, 7, 8, 9), (3, b, 7, 8, 9), (4, None, 7, 8, 9), (None, "", 7, 8, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __own int, __id int, h int")
    got = jaccard_join.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r["__own"], r["__id"], r.h) for r in got.collect()) == [(0, 7, 8, 9), (1, 7, 8, 9), (3, 7, 8, 9), (4, 7, 8, 9)]
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0


def test_quotes(spark):
    data = [(1, 0, "u", "Hello there everyone.\nThe second line is here."), (1, 1, "a", "On Monday X wrote:\n> Hello there   everyone.\n> The second line is here\nMy answer is long."),
            (1, 2, "u", "> > hello there everyone\n> My answer is long.\nThanks a lot, friend"), (1, 3, "u", "> The second line is here.\n\nok then"),
            (2, 0, "u", "> My answer is long.\nfrom elsewhere"), (2, 1, "x", None), (None, None, None, "> hello there everyone"), (2, 1, "x", "")]
    got = [(r.conv_id, r.turn, r.text, r.parent_conv, r.parent_turn, r.root_turn, r.depth) for r in quotes.link(spark.createDataFrame(data, "conv_id long, turn int, role string, text string")).collect()]
    assert (1, 1, "My answer is long.", 1, 0, 0, 1) in got and (1, 2, "Thanks a lot, friend", 1, 1, 0, 2) in got
    assert (1, 3, "ok then", 1, 0, 0, 1) in got and (2, 0, "from elsewhere", 1, 1, 0, 0) in got and len(got) == 8
    assert [g[1] for g in got if g[0] == 1] == [0, 1, 3, 2]  # a reply follows what it answers


def parents(spark, data):
    got = quotes.link(spark.createDataFrame(data, "conv_id long, turn int, role string, text string")).collect()
    return {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in got if r.max_level}


def test_short_quotes(spark):
    data = [(1, 0, "u", "42?"), (1, 1, "a", "Yes."), (1, 2, "u", "> Yes.\nfine by me then"), (1, 3, "a", "> 42?\nof course it is"), (1, 4, "u", "今日は雨。"), (1, 5, "a", "> 今日は雨。\nbring an umbrella"),
            (2, 0, "u", "> Yes.\nhas its original elsewhere"), (3, 0, "u", "The long line of text."), (3, 1, "a", "ok"), (3, 2, "u", "> The long line of text.\n> ok\n> and one more\nreply")]
    assert parents(spark, data) == {(1, 2): (1, 1), (1, 3): (1, 0), (1, 5): (1, 4), (2, 0): (1, 1), (3, 2): (3, 0)}


def test_quotes_from_elsewhere(spark):
    passage, three = "This passage was sent around.", "First part of the letter\nwrapped here.\n\nThe second part of it.\n\nA third and last part."
    data = [(5, 0, "u", passage), (6, 0, "u", f"> {passage}\n{passage}"), (6, 1, "a", "no"), (7, 0, "u", f"> {passage}\nlook at this"), (7, 1, "a", passage),
            (1, 0, "u", f"> {passage}\nsee below"), (1, 1, "u", passage), (8, 0, "u", three), (8, 1, "a", "> First part of the\n> letter wrapped here.\n>\n> The second part\n> of it.\nagreed, both of them"),
            (9, 0, "u", "> Nobody else said this.\nNobody else said this.")]
    assert parents(spark, data) == {(6, 0): (1, 1), (7, 0): (1, 1), (1, 0): (5, 0), (8, 1): (8, 0), (9, 0): (None, None)}


def test_pipeline_matches_its_operators(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf).toPandas()
    ids = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(out) and set(out.doc_id) <= ids and out.groupby("sequence_id").length.sum().max() <= 2048
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
