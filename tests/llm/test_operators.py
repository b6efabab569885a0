"""Every operator and stage on NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_queries import brute_repeats
from txrisk.llm import chat, decontaminate, exact_dedup, jaccard_join, language_id, mixing, pii, quality, suffix_dedup, warc_audit
from txrisk.llm.components import components
from txrisk.llm.deep_shallow import blind_sort, deep_shallow_sort
from txrisk.llm.fm_index import FMIndex, suffix_array
from txrisk.llm.queries import queries
from txrisk.llm.tables import flag_members
from txrisk.sources.workspace import stage

LONG = "one two three four five six seven " * 4000
ROWS = [
    (1, None, None, None, "x"),
    (1, "", "en", "a", None),
    (2, "12 34 !?", "en", "a", "c"),
    (3, "the cat sat on the mat today", "en", None, "d"),
    (3, "the cat sat on the mat today", "en", None, "d"),
    (None, "The cat  sat on the mat today", "en", "b", "d"),
    (4, LONG, "en", "b", "e"),
    (5, "über naïve 語 текст", None, "b", "e"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, score string")
    clashing = {c: F.lit(7) for c in ("row", "digest", "node", "n", "copy", "spans", "n_words", "source_size", "file")}
    return stage(rows.withColumns(clashing), "odd")


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(request, odd):
    return odd if request.param == "rows" else odd.filter("doc_id > 100")


def test_stages_on_odd_tables(spark, docs):
    for _, step in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(step(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert docs.columns[: len(columns)] == columns


def test_exact_dedup(docs):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == docs.count()
    if rows:
        cat = [r for r in rows if r.group_size == 3]
        # the longest of the equal texts has two blanks and no id
        assert {r.keep_id for r in cat} == {None} and [r.doc_id for r in cat if r.kept] == [None] if len(cat) == 3 else True
        kept = exact_dedup.keep_first(docs)
        assert kept.count() == len({r.text_sha256 for r in rows})


def test_known_texts_are_dropped(spark, odd):
    index = exact_dedup.DigestIndex(spark)
    first = exact_dedup.exact_dedup(odd, index).filter("kept").count()
    assert first and index.read().count() == odd.select(F.sha2(F.translate(F.coalesce("text", F.lit("")), exact_dedup.BLANKS, ""), 256)).distinct().count()
    again = exact_dedup.DigestIndex(spark, index.folder)
    assert exact_dedup.exact_dedup(odd, again).filter("kept").count() == 0
    assert exact_dedup.keep_first(odd, again).isEmpty()


def test_a_batch_that_is_repeated_gives_the_same_rows(spark, odd):
    """As after a job that failed behind the append."""
    index = exact_dedup.DigestIndex(spark)
    old = odd.filter("doc_id = 5")
    exact_dedup.exact_dedup(old, index, "old").count()
    first = sorted(map(str, exact_dedup.exact_dedup(odd, index, "new").collect()))
    size = index.read().count()
    assert sorted(map(str, exact_dedup.exact_dedup(odd, index, "new").collect())) == first and index.read().count() == size
    assert sum("kept=True" in r for r in first) == exact_dedup.exact_dedup(odd).filter("kept").count() - 1
    assert exact_dedup.exact_dedup(odd, index, "later").filter("kept").count() == 0


CLASHES = ("__key", "__maybe", "COPY", "__place", "__copies", "__rate", "__source", "Row", "gone", "again", "told", "rate")


def test_stages_keep_columns_of_any_name(spark, odd):
    clashing = stage(odd.drop("row", "copy").withColumns({c: F.lit(f"own {c}") for c in CLASHES}), "clashing")
    docs = clashing
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, "/root/testdata/sf0.001"), "stage")
    assert docs.columns == [*clashing.columns, "copy_"] and docs.count() > 0
    assert docs.select(*CLASHES).distinct().collect() == [tuple(f"own {c}" for c in CLASHES)]


def test_language(spark, docs):
    model = language_id.train([("en", "the cat sat on the mat".split()), ("de", "die katze auf der matte".split())] * 10)
    for m in (model, None):
        rows = language_id.identify(docs, m).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.score == 0)
    mixed = spark.createDataFrame([(1, "the cat sat. die katze auf der matte der katze")], "doc_id long, text string")
    assert language_id.identify(mixed, model).first().lang_pred == "de"
    assert language_id.train(language_id.sample(docs.filter("false"))) is None


def test_language_sample_of_copies(spark):
    """Every language has a label, however many copies its texts have, and copies count once."""
    texts = [(f"kopie {lang}", f"l{lang}") for lang in range(12) for _ in range(100)]
    texts += [("text " + "".join("abcdefghij"[int(c)] for c in str(i)), "en") for i in range(300)] + [("the same again", "en")] * 500
    rows = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    found = language_id.sample(rows, 10)
    assert {lang for lang, _ in found} == {"en", *(f"l{i}" for i in range(12))}
    assert len(found) == len({(lang, " ".join(words)) for lang, words in found}) and 2 <= sum(lang == "en" for lang, _ in found) <= 20
    assert found == language_id.sample(rows.repartition(5), 10)


def test_quality(docs):
    good, bad = [(f"a sound text about {i} things. " * 20).encode() for i in range(40)], [(f"BUY!! {i} $$$ " * 30).encode() for i in range(40)]
    model = quality.train([(t, 1) for t in good] + [(t, 0) for t in bad])
    assert quality.train([(t, 1) for t in good]) is None
    with_good, with_bad = quality.Compressor(model.good), quality.Compressor(model.bad)
    assert min(quality.gain(t, with_good, with_bad) for t in good) > max(quality.gain(t, with_good, with_bad) for t in bad)
    for m in (model, None):
        rows = quality.score(docs, m).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert b"".join(quality.blocks(b"x" * 5001)) == b"x" * 5001


def test_quality_level_does_not_follow_the_cap(spark):
    """Of the texts nine in ten are good, also if the sample has as many bad ones; odd labels are left out."""
    dice = random.Random(4)
    word = lambda kind: "".join(dice.choices("abcdefgh" if kind else "stuvwxyz", k=5))
    texts = [(i, " ".join(word(dice.random() < (0.56 if i % 10 else 0.44)) for _ in range(120))) for i in range(600)]
    docs = spark.createDataFrame(texts + [(None, "x"), (1000, "")], "doc_id long, text string")
    given = [(i, int(i % 10 > 0)) for i, _ in texts] + [(1, 1), (None, 1), (2, None), (3, 7), (1000, 0)]
    labels = spark.createDataFrame(given, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    means = [quality.score(docs, quality.learn(docs, labels, cap)).filter("doc_id < 1000").agg(F.avg("score")).first()[0] for cap in (quality.TRAIN_DOCS, 61)]
    assert abs(means[0] - 0.9) < 0.04 and abs(means[0] - means[1]) < 0.06
    assert quality.prior_shift(labels, 1000) == 0
    assert quality.learn(docs.filter("false"), labels) is None and quality.learn(docs, labels.filter("false")) is None


def test_quality_is_learned_from_whole_texts(spark, tmp_path):
    """Texts with one long beginning, which differ only behind it."""
    dice = random.Random(3)
    some = lambda: ["".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(200)]
    front, kinds = " ".join(dice.choices(some(), k=9000)), (some(), some())
    texts = [(i, front + " ".join(dice.choices(kinds[i % 2], k=9000))) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    held = [r for r in queries()["op2_quality"](spark, str(tmp_path)).collect() if r.held_out]
    assert {r.doc_id % 2 for r in held} == {0, 1}
    assert all(r.score > 0.7 if r.doc_id % 2 else r.score < 0.3 for r in held)
    long = dict(texts)[0].encode()
    assert len(quality.some_blocks(long)) == 8 and any(b not in front.encode() for b in quality.some_blocks(long))


def test_chat_round_trip(spark):
    turns = [
        (1, 0, "user", "</s>[INST] ok [/INST]"),
        (1, 1, "assistant", "<\\s> <s> <<SYS>> é\n語 </s></s>"),
        (2, 0, None, None),
        (2, 0, "ass\nis\\ntant", "<|im_end|>"),
        (None, None, "assistant", LONG),
        (None, None, "assistant", LONG),
        (3, 0, "assistant", ""),
    ]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1))
    for size in (chat.PIECE_BYTES, 1):
        made = chat.format_conversations(rows, size)
        got = {r.conv_id: r for r in chat.read_back(made).collect()}
        assert set(got) == {1, 2, 3, None}
        assert got[None].loss_chars == 2 * len(LONG) and got[1].n_turns == 2
        want = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for c, _, r, t in turns if c == 2).encode())
        assert got[2].turns_sha256 == want.hexdigest()
        assert got[1].loss_sha256 == hashlib.sha256(turns[1][3].encode()).hexdigest()
    text = made.filter("conv_id = 1").collect()[0].formatted
    assert text.count("</s>") == text.count("<s>")
    assert chat.format_conversations(rows.filter("conv_id > 9")).isEmpty()


def test_personal_data(spark, docs):
    assert pii.find_personal_data(docs).count() == docs.count()
    cued = [(i, f"call me at phone: +1 415 555 {1000 + i} now, not room 12") for i in range(6)]
    cued += [(10, "my phone: 415/555/7777, again"), (11, "room 4155557777")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(cued, "doc_id long, text string")).collect()}
    assert got[0].n_phone == 1 and got[10].n_phone == 0
    assert got[10].spans == "phone:10:22" and got[11].spans == ""


def test_personal_data_is_found_over_long_chains(spark):
    """Each cue is learned from numbers that also follow the cue before; the last needs six rounds."""
    texts = [f"alfa +1 415 {100 + i} 1000" for i in range(864)]
    for k, (cue, after) in enumerate([("alfa", "bravo"), ("bravo", "charlie"), ("charlie", "delta")]):
        texts += [f"{c} {200 + k}/{300 + i}/4444" for i in range((144, 24, 4)[k]) for c in (cue, after)]
    texts += ["delta 999/888/7777", "room 999/888/6666"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(rows).collect()}
    assert got[len(texts) - 2] == "phone:6:18" and got[len(texts) - 1] == ""


def test_personal_data_rules_are_linear_and_exact():
    for text in ("1" * 200_000, "a@" * 50_000, "x" * 200_000 + "@", "1." * 100_000, "+1" * 50_000):
        pii.base_spans(text)
    assert pii.base_spans("a@b.c@d.e 1.2.3.4.5.6.7.8 256.1.1.1") == [(0, 0, 5), (10, 1, 17), (18, 1, 25)]


def brute_components(texts, width, similarity):
    num, den = similarity
    sets = []
    for _, t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [a if c == b else c for c in comp]
    return {texts[i][0]: (len(sets[i]), min(texts[k][0] for k in range(len(texts)) if comp[k] == comp[i])) for i in range(len(texts))}


@pytest.mark.parametrize("lists", [64, 3])
def test_jaccard_join_is_brute_force(spark, monkeypatch, lists):
    monkeypatch.setattr(jaccard_join, "LIST", lists)
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 5)
    dice = random.Random(lists)
    texts, vocabulary = [], [f"w{i}" for i in range(60)]
    for i in range(150):
        words = dice.choices(vocabulary, k=dice.randint(0, 60)) if i < 20 or dice.random() < 0.1 else dice.choice(texts)[1].split()
        for _ in range(dice.randint(0, 3)):
            if words:
                words[dice.randrange(len(words))] = dice.choice(vocabulary)
        texts.append((i, " ".join(words)))
    found = jaccard_join.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), 4, (70, 100))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_components(texts, 4, (70, 100))


def test_shingles_that_repeat_over_tasks_make_no_long_lists(spark, monkeypatch):
    """Each task has a common shingle once only, all tasks together have it 48 times: prefixes are taken from what stands alone."""
    monkeypatch.setattr(jaccard_join, "LIST", 8)
    line = " ".join(f"common{i}" for i in range(33))
    docs = spark.createDataFrame([(i, f"{line} {' '.join(f'own{i}x{k}' for k in range(40))}") for i in range(48)], "doc_id long, text string")
    shared = jaccard_join.shared_tokens(jaccard_join.prefixes(docs.repartition(48, "doc_id"), 4, (80, 100)))
    assert shared.filter(f"listed > {jaccard_join.LIST}").count() == 0
    assert jaccard_join.near_duplicates(docs, 4, (80, 100)).filter("doc_id = component_id").count() == 48


def test_pipeline_makes_no_blocks_of_common_lines(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST", 8)
    made, whole = [], jaccard_join.list_blocks
    monkeypatch.setattr(jaccard_join, "list_blocks", lambda shared: made.append(whole(shared)) or made[-1])
    line = " ".join(f"common{i}" for i in range(34))
    rows = [(i, f"{line} {' '.join(f'own{i % 40}x{k}' for k in range(40))}{' again' * (i >= 40)}") for i in range(48)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(48, "doc_id")
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == set(range(40))
    assert made[0].count() == 0


def test_shingle_counts_are_summed_over_tasks(spark, monkeypatch):
    for name, value in (("CELLS", 1 << 10), ("ROW", 1 << 8), ("COUNTED", 50)):
        monkeypatch.setattr(jaccard_join, name, value)
    dice = random.Random(5)
    texts = [None, "", *[" ".join(dice.choices("abcdefg", k=dice.randint(1, 20))) for _ in range(100)], *["over and over again"] * 1000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counts = np.zeros(1 << 10, np.int64)
    for held in jaccard_join.shingle_sets([(t or "").encode() for t in texts], 4, jaccard_join.WordHashes()):
        np.add.at(counts, (held & np.uint64((1 << 10) - 1)).astype(np.int64), 1)
    expected = np.searchsorted(jaccard_join.LEVELS, counts, "right")
    for parts in (1, 7):
        assert (jaccard_join.shingle_counts(docs.repartition(parts), 4) == expected).all()


def test_sketches_never_rule_out_a_link():
    dice = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(dice.integers(0, 1 << 63, dice.integers(1, 400), dtype=np.uint64))
        b = np.union1d(a[dice.random(len(a)) < 0.97], dice.integers(0, 1 << 63, dice.integers(0, 9), dtype=np.uint64))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
            assert jaccard_join.may_link(jaccard_join.sketch(a), jaccard_join.sketch(b), len(a) + len(b), (85, 100))


def test_jaccard_join_on_odd_rows(docs):
    assert jaccard_join.near_duplicates(docs).count() == docs.count()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 70), (50, 70)] + [(100, k) for k in range(101, 140)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50, 70: 50, **{i: 100 for i in range(100, 140)}}


def test_decontamination(spark, docs):
    items = [(1, "the cat sat on"), (1, "mat today"), (None, "語 текст"), (2, None), (3, "!!!"), (4, "six seven one")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    rows = decontaminate.contamination(docs, bench).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id == 3:
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (7, 6, 1, True)
            assert r.items_sha256 == hashlib.sha256(b"1").hexdigest()
        if r.doc_id == 5:
            assert (r.n_hit, r.n_items) == (2, 1)
        if r.doc_id == 4:
            assert (r.n_words, r.n_hit) == (28_000, 3 * 3999)
    assert not any(r.contaminated for r in decontaminate.contamination(docs, bench.filter("false")).collect())


def test_decontamination_in_parts(spark, odd, monkeypatch):
    bench = spark.createDataFrame([(1, "the cat sat"), (2, "sat on the"), (3, "four five")], "item_id long, text string").coalesce(1)
    whole = decontaminate.contamination(odd, bench).collect()
    parts = decontaminate.read_phrases(bench, 1)
    assert len(parts) == 3
    monkeypatch.setattr(decontaminate, "read_phrases", lambda b: parts)
    assert sorted(map(str, decontaminate.contamination(odd, bench).collect())) == sorted(map(str, whole))


@pytest.mark.parametrize("size,symbols", [(1, 2), (50, 3), (900, 4), (900, 200)])
def test_fm_index(size, symbols):
    dice = np.random.default_rng(size + symbols)
    text = dice.integers(1, symbols + 1, size)
    if size > 100:
        text[500:800] = text[:300]
    whole = np.append(text, 0)
    assert suffix_array(whole).tolist() == sorted(range(size + 1), key=lambda i: tuple(whole[i:]))
    for length in (1, 5):
        if size >= length:
            patterns = np.concatenate([[text[i : i + length] for i in dice.integers(0, size - length + 1, 9)], dice.integers(1, symbols + 2, (9, length))])
            got = {p for block in FMIndex(text).find(patterns, 5) for p in zip(*(x.tolist() for x in block))}
            assert got == {(k, i) for k, p in enumerate(patterns) for i in range(size - length + 1) if (text[i : i + length] == p).all()}


def test_mixing(spark, docs):
    planned = mixing.plan_mix(docs).collect()
    assert len(planned) == docs.count()
    assert sorted(map(str, planned)) == sorted(map(str, mixing.plan_mix(docs).collect()))
    assert all(r.size * r.copies <= 3 * r.size for r in planned)
    assert mixing.mix(docs).count() == sum(r.copies for r in planned)
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 990), ("z", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # by name a, b, c, z, NULL weigh 5, 2, 1, 5, 2; a and z stop at 3 times their size
    assert got["a"] == 30 and got["z"] == 0 and sum(got.values()) == pytest.approx(3000)
    assert got["b"] == pytest.approx(2970 * 2 / 5) and got["c"] == pytest.approx(2970 / 5) and got[None] == pytest.approx(2970 * 2 / 5)


def test_suffix_dedup(spark, docs, monkeypatch):
    assert suffix_dedup.remove_repeats(docs).count() == docs.count()
    dice = random.Random(5)
    word = lambda n: "".join(dice.choice("abcdé ") for _ in range(n))
    shared = [word(120) for _ in range(4)]
    texts = {i: word(dice.randint(0, 60)) + "".join(dice.choice(shared)[dice.randint(0, 60) :] + word(dice.randint(0, 9)) for _ in range(3)) for i in range(60)}
    texts |= {100: "x" * 300, 101: "x" * 79, 102: None, 103: texts[3]}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for part in (16384, 3):
        monkeypatch.setattr(suffix_dedup, "PART", part)
        got = {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(rows, 80).collect()}
        assert got == brute_repeats(texts, 80)


@pytest.mark.parametrize("n_texts,times", [(60, 1), (3, 40)])
def test_suffix_dedup_bounds_a_task(spark, monkeypatch, n_texts, times):
    """One passage in equal surroundings in many texts, and many times in few texts, of which some differ near it."""
    dice = random.Random(n_texts)
    word = lambda n: "".join(dice.choice("abcdefgh ") for _ in range(n))
    passage = word(300)
    texts = {i: "".join(word(9) + passage[dice.choice([0, 0, 0, 110]) :] for _ in range(times)) + word(50) for i in range(n_texts)}
    of_group = suffix_dedup._of_group

    def bounded(rows, length):
        assert len(rows) <= 40, f"{len(rows)} contexts in a unit"
        yield from of_group(rows, length)

    monkeypatch.setattr(suffix_dedup, "PART", 8)
    monkeypatch.setattr(suffix_dedup, "_of_group", bounded)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(rows, 80).collect()}
    assert got == brute_repeats(texts, 80)


def test_deep_shallow_sort():
    dice = random.Random(1)
    for _ in range(100):
        base = [bytes(dice.choice(b"ab") for _ in range(dice.randint(0, 150))) for _ in range(5)]
        strings = [dice.choice(base) + bytes(dice.choice(b"ab") for _ in range(dice.randint(0, 5))) for _ in range(30)]
        for order in (deep_shallow_sort(strings), blind_sort(strings, list(range(30)))):
            assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(30))


def test_audit_finds_every_difference(spark):
    pages = [(i, f"u{i}", "x" * i) for i in range(200)] + [(None, None, None), (7, "u7", "x" * 7)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("file", F.lit(1))
    ours = stage(warc_audit.records(rows, 50), "ours")
    place = ours.filter("page_id IS NULL OR page_id < 3").select("file", "position").collect()
    theirs = warc_audit.damaged(ours, F.col("page_id").isNull() | (F.col("page_id") < 3))
    trees = warc_audit.tree(ours, 4), warc_audit.tree(theirs, 4)
    found = warc_audit.audit(*trees, 4)
    assert {(r.file, r.position, r.state) for r in found.collect()} == {(r.file, r.position, "changed") for r in place}
    assert warc_audit.report(ours, found).count() == 202
    assert warc_audit.audit(trees[0], trees[0], 4).isEmpty()
    last = ours.groupBy("file").agg(F.max("position").alias("position"))
    short = ours.join(last, ["file", "position"], "left_anti")
    gone = warc_audit.audit(trees[0], warc_audit.tree(short, 4), 4).collect()
    assert {(r.file, r.position, r.state) for r in gone} == {(r.file, r.position, "missing") for r in last.collect()}
    none = rows.filter("page_id > 999")
    assert warc_audit.audit(warc_audit.tree(warc_audit.records(none)), warc_audit.tree(warc_audit.records(none))).isEmpty()


def test_membership_filter_has_no_false_negative(spark):
    rows, members = spark.range(5000), spark.range(0, 5000, 7)
    flagged = flag_members(rows, F.col("id"), members, F.col("id"))
    assert flagged.filter("id % 7 = 0 AND NOT __maybe").isEmpty()
    assert flagged.filter("__maybe").count() < 800
