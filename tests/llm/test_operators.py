"""The operators on small tables against brute force, and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter

from stratum.llm import (
    bin_packing, chat_format, decontaminate, language_id, license_scan, ngram_join, oracle, quality_classifier,
    quality_rules, queries, slots, stage, substring_dedup, token_packing, tokens, words,
)

from tools.check_oracle import digest, duck

DOCS = "doc_id long, text string, lang string, source string, n_chars long, item_id long, label string"


def docs_of(spark, rows):
    full = [(i, t, lang, src, len(t or ""), 5, "x") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns whose names clash with results."""
    long = sentence(1, 20_000)
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "one two", "en", "a"), (3, "one two", "en", "a"), (None, "one two", None, "a"),
            (4, long, "en", "a"), (5, long, "en", None), (6, sentence(2, 80), "fr", "b"), (None, None, None, None), (7, " \n\t ", "fr", "b")]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


def test_tokens_equal_whole_texts():
    t = tokens.word_tokenizer(tokens.default_vocabulary())
    texts = ["", "  ", "a.b. c.'s d.,  é. “x”. İstanbul Σας <|endoftext|> x", "é á. ́ x\x85y\x1cz 12.5, it's. don't, A.M.", sentence(3, 300) + ". End."]
    for x in texts * 2:
        assert np.frombuffer(t.encode(x), dtype=tokens.ID_DTYPE).tolist() == t.tokenizer.encode(x, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25), st.sampled_from([slots.best_fit_decreasing, slots.match_large]))
def test_plans_fill_bins_without_overlap(sizes, planner):
    plan = planner(sizes, 40)
    bins = collections.defaultdict(list)
    for size, n in sizes.items():
        b, o = slots.place(plan.arrays(), np.full(n, size), np.arange(n))
        for x, y in zip(b.tolist(), o.tolist()):
            bins[x].append((y, size))
    assert len(bins) == plan.bins
    for own in bins.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= 40
    total = sum(s * n for s, n in sizes.items())
    assert plan.bins >= -(-total // 40)
    if planner is slots.match_large:
        assert all(sum(3 * s > 40 for _, s in own) <= 2 for own in bins.values())


def test_token_matrices_round_trip(spark, odd, none):
    rows = token_packing.packed_matrices(odd, capacity=64, window_tokens=5000).collect()
    t = tokens.word_tokenizer(tokens.default_vocabulary())
    got = collections.defaultdict(list)
    for r in rows:
        ids, pos, cu = np.frombuffer(r.input_ids, "<u4"), np.frombuffer(r.position_ids, "<u4"), r.cu_seqlens
        assert len(ids) == 64 and cu[0] == 0 and cu[-1] == r.n_tokens and not ids[r.n_tokens:].any()
        for doc, start, a, b in zip(r.doc_ids, r.starts, cu, cu[1:]):
            assert pos[a:b].tolist() == list(range(b - a))
            got[doc].append((start, ids[a:b].tolist()))
    want = collections.Counter()
    for r in odd.collect():
        want[r.doc_id] += len(t.tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    assert {d: sum(len(i) for _, i in x) for d, x in got.items()} == dict(want)
    text = odd.where("doc_id = 6").first().text
    assert sum((i for _, i in sorted(got[6])), []) == [*t.tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert token_packing.packed_matrices(none).count() == 0


def test_best_fit_packing(spark, odd, none):
    rows = bin_packing.best_fit_packing(odd).collect()
    t = tokens.word_tokenizer(tokens.default_vocabulary())
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 4096
    long = np.array([*t.tokenizer.encode(odd.where("doc_id = 4").first().text, add_special_tokens=False).ids, 1], dtype="<u4")
    got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == 4)
    assert got == [(i, s, len(long[s:s + 4096]), zlib.crc32(long[s:s + 4096].tobytes())) for i, s in enumerate(range(0, len(long), 4096))]
    assert len(bins) == -(-sum(r.length for r in rows) // 4096)
    assert bin_packing.best_fit_packing(none).count() == 0


def test_quality_rules(spark, odd, none):
    got = {(r.doc_id, r.n_words): r for r in quality_rules.quality_verdicts(odd).collect()}
    assert got[(1, 0)].base_failed and not got[(1, 0)].kept and got[(6, 80)].kept and got[(4, 20_000)].kept
    assert quality_rules.quality_verdicts(odd).count() == odd.count()
    kept = quality_rules.kept_documents(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6]
    assert quality_rules.quality_verdicts(none).count() == 0 and quality_rules.kept_documents(none).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t#|A\x1c", max_size=60))
def test_text_counts_against_brute_force(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    assert quality_rules.text_counts(t)[:5] == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_kept_documents_counts_a_text_once(spark, odd):
    plan = quality_rules.kept_documents(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("run", [ngram_join.near_duplicates, substring_dedup.without_passages])
def test_texts_go_to_workers_in_small_batches(spark, monkeypatch, run):
    seen = []
    put = DataFrameWriter.parquet

    def noted(self, path, *args, **options):
        seen.append((path, int(spark.conf.get(stage.BATCH_CONF))))
        return put(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    run(docs_of(spark, [(i, sentence(i % 3, 80), "en", "a") for i in range(6)])).collect()
    rows = {path.split("/")[-2]: n for path, n in seen}
    assert all(n == stage.BATCH_ROWS for name, n in rows.items() if name in ("signatures", "links", "chains", "parts")) and len(rows) > 2
    assert int(spark.conf.get(stage.BATCH_CONF)) > stage.BATCH_ROWS


def test_quality_rules_reject_outliers_of_their_group(spark):
    rows = [(i, sentence(i, 100), "en", f"s{i % 3}") for i in range(330)] + [(1000 + i, sentence(i, 100).replace(" ", " ### "), "en", "s0") for i in range(20)]
    got = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs_of(spark, rows)).collect()}
    assert all(got[i] for i in range(330)) and not any(got[1000 + i] for i in range(20))


def test_quality_rules_keep_scripts_without_spaces(spark):
    rng = np.random.default_rng(11)

    def lines(low, high):  # 60 lines, each one "word"
        return "\n".join("".join(map(chr, rng.integers(0x4E00, 0x9F00, int(rng.integers(low, high))))) for _ in range(60))

    rows = [(i, lines(100, 300), "zh", "a") for i in range(150)] + [(1000 + i, lines(2000, 3000), "zh", "a") for i in range(5)]
    got = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs_of(spark, rows)).collect()}
    assert all(got[i] for i in range(150)) and not any(got[1000 + i] for i in range(5))


def test_buckets_hold_their_values_without_a_top(spark):
    values = [0, 9, 10, 999, 1000, 90_999, 91_000, 91_099, 91_100, 91_200, 150_000, 10 ** 7, 10 ** 12]
    v = spark.createDataFrame([(x,) for x in values], "v long")
    got = v.select("v", quality_rules._value(quality_rules._bucket(v["v"])).alias("end")).collect()
    assert all(r.v - 1 <= r.end <= r.v + max(100, 0.0011 * r.v) for r in got)


def test_near_duplicates_against_brute_force(spark, odd, none):
    rng = np.random.default_rng(7)
    rows, n = [], 0
    for g in range(12):
        base = sentence(g, 120).split()
        for c in range(int(rng.integers(1, 9))):
            w = list(base)
            for k in rng.integers(0, 120, c % 4):
                w[k] = f"x{n}"
            rows.append((n, " ".join(w), "en", "a"))
            n += 1
    rows += [(n, rows[0][1], "en", "b"), (n + 1, "tiny text", "en", "a"), (n + 2, "tiny text", "en", "a"), (n + 3, None, None, None)]
    sets = {i: ({tuple(t.split()[k:k + 5]) for k in range(max(1, len(t.split()) - 4))} if t else set()) for i, t, _, _ in rows}
    near = {i: {j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in sets}

    def group(i):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        return min(seen)

    # small blocks: clusters span several
    got = ngram_join.near_duplicates(docs_of(spark, rows), block=2).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {i: (group(i), len(near[i])) for i in sets}
    assert sorted(r.doc_id for r in got if r.stays) == sorted({group(i) for i in sets})
    one = ngram_join.one_of_each(odd)
    assert one.columns == odd.columns
    # of the rows "one two" (ids 3, 3, null) one stays, of the two long ones one; rows without words stay
    left = sorted((r.doc_id is None, r.doc_id or 0) for r in one.collect())
    assert [i for n, i in left if not n] == [1, 2, 3, 4, 6, 7] and sum(n for n, _ in left) == 1
    assert ngram_join.near_duplicates(none).count() == 0


def test_bands_reach_the_recall():
    b = ngram_join.choose_bands(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** 8) ** b >= 0.9995 > 1 - (1 - 0.8 ** 8) ** (b - 1)


def test_passages(spark, odd, none):
    shared = sentence(100, 70)
    fuzzy = shared.split()
    fuzzy[30] = "changed"
    rows = [(1, sentence(1, 90) + " " + shared, "en", "a"), (2, shared + "\n" + sentence(2, 60), "en", "a"),
            (3, sentence(3, 40) + " " + " ".join(fuzzy) + " " + sentence(4, 30), "en", "a"), (4, sentence(5, 200), "en", "a"),
            (5, sentence(6, 60) + " " + " ".join(shared.split()[:30]), "en", "a")]
    docs = docs_of(spark, rows)
    got = {(r.doc_id, r.ref_doc_id): (r.start, r.end, r.ref_start, r.ref_end, r.matched) for r in substring_dedup.fuzzy_passages(docs).collect()}
    assert got[(2, 1)] == (0, 70, 90, 160, 70) and got[(3, 1)] == (40, 110, 90, 160, 69)
    # a seed that only the later two have chosen may add a span within the passage
    assert set(got) <= {(2, 1), (3, 1), (3, 2)} and all(40 <= s and e <= 110 for (d, _), (s, e, *_) in got.items() if d == 3)
    cut = {r.doc_id: r for r in substring_dedup.without_passages(docs).collect()}
    assert cut[2].text == sentence(2, 60) and cut[2].n_chars == len(cut[2].text)
    assert cut[3].text.split() == (sentence(3, 40) + " " + sentence(4, 30)).split()
    assert all(cut[i].text == rows[i - 1][1] for i in (1, 4, 5))
    out = substring_dedup.without_passages(odd)
    assert out.columns == odd.columns and sorted((r.doc_id or 0, len(r.text or "")) for r in out.collect()) == sorted(
        (r.doc_id or 0, len(r.text or "")) for r in odd.where("doc_id is null or doc_id <> 5").collect())
    assert substring_dedup.fuzzy_passages(none).count() == 0 and substring_dedup.without_passages(none).count() == 0


@pytest.mark.parametrize("length,rate,least", [(60, 0.05, 0.95), (60, 0.1, 0.8), (80, 0.1, 0.9), (120, 0.15, 0.8)])
def test_passages_with_edits_are_found(spark, length, rate, least):
    rng, rows, n = np.random.default_rng(length), [], 100
    for i in range(n):
        passage = sentence(10_000 + i, length).split()
        edited = [f"new{k}" if rng.random() < rate else w for k, w in enumerate(passage)]
        rows += [(i, sentence(20_000 + i, 30) + " " + " ".join(passage) + " " + sentence(30_000 + i, 30), "en", "a"),
                 (1000 + i, sentence(40_000 + i, 30) + " " + " ".join(edited) + " " + sentence(50_000 + i, 30), "en", "a")]
    spans = substring_dedup.fuzzy_passages(docs_of(spark, rows)).collect()
    assert all(r.doc_id == r.ref_doc_id + 1000 and 30 <= r.start and r.end <= 30 + length for r in spans)
    assert len({r.doc_id for r in spans}) >= least * n, len({r.doc_id for r in spans})


def test_an_exact_passage_survives_looser_text_chained_to_it():
    near = [f"w{i}".encode() for i in range(160)]
    # 55 exact words, then two pieces of 48 words that begin with a seed and match in 20 of the other 40; a seed ends them
    keep = {*range(55), *range(55, 63), *range(64, 103, 2), *range(103, 111), *range(112, 151, 2), *range(151, 159)}
    words_ = [w if i in keep else b"x%d" % i for i, w in enumerate(near)]
    pos = [0, 8, 16, 24, 32, 40, 47, 55, 103, 151]
    spans = list(substring_dedup.align(words_, near, 0, pos, pos, 8))
    assert any(s == 0 and e >= 55 for s, e, *_ in spans)
    assert all(m >= 0.8 * (e - s) and m == sum(words_[i] == near[i] for i in range(s, e)) for s, e, _, _, m in spans)


def test_a_passage_is_one_that_a_single_earlier_document_holds(spark):
    a, b = sentence(200, 30), sentence(201, 30)
    rows = [(1, a + " " + sentence(1, 60), "en", "a"), (2, sentence(2, 60) + " " + b, "en", "a"),
            (4, " ".join([sentence(4, 40), a, b, sentence(5, 40)]), "en", "a"),
            # the parts' latest documents before 9 hold one part each
            (6, sentence(6, 50) + " " + a, "en", "a"), (7, sentence(7, 50) + " " + b, "en", "a"),
            (9, " ".join([sentence(8, 30), a, b, sentence(9, 50)]), "en", "a")]
    docs = docs_of(spark, rows)
    cut = {r.doc_id: r.text for r in substring_dedup.without_passages(docs).collect()}
    assert all(cut[i] == t for i, t, _, _ in rows if i != 9)
    assert cut[9].split() == (sentence(8, 30) + " " + sentence(9, 50)).split()
    assert {(r.doc_id, r.ref_doc_id, r.region_start, r.region_end) for r in substring_dedup.fuzzy_passages(docs).collect()} == {(9, 4, 30, 90)}


def test_seeds_meet_their_first_and_their_previous_document(spark):
    places = [(s, d, p) for s in (5, 6) for d, p in [(1, 9), (1, 3), (4, 0), (4, 8), (7, 2), (-2 ** 63, 1)][s - 5:] if s == 5 or d > 0] + [(8, 30 * d, d) for d in range(40)]
    first = {s: min((d, p) for x, d, p in places if x == s) for s, _, _ in places}
    shared = spark.createDataFrame([(s, d, p, *first[s]) for s, d, p in places], "seed long, doc_id long, pos int, ref long, at int")
    want = set()
    for s, d, p in places:
        if earlier := [(x, y) for z, x, y in places if z == s and x < d]:
            previous = max(x for x, _ in earlier)
            want |= {(d, first[s][0], p, first[s][1]), (d, previous, p, min(y for x, y in earlier if x == previous))}
    for ids in ([], [1], [-2 ** 63, 4, 300, 600]):
        assert {tuple(r) for r in substring_dedup.anchored(shared, ids).collect()} == want


def test_seeds_of_texts_together_equal_those_of_each():
    texts = ["", " \n ", "a b", "x " * 60, sentence(1, 11), sentence(2, 12), sentence(3, 13), " " + sentence(4, 300) + "\x0b\x0c", "ΑΣ İ \x85 " * 30, sentence(5, 70).upper()]
    for k, window, least in ((6, 4, 50), (6, 4, 1), (8, 6, 12)):
        marks, text, places = substring_dedup.chosen(texts, k, window, least)
        for i, t in enumerate(texts):
            own = words.split_words(t)
            grams = words.gram_hashes(words.word_hashes(own), k)
            want = substring_dedup.winnow(grams, window) if len(own) >= least else np.empty(0, dtype=int)
            assert places[text == i].tolist() == want.tolist() and marks[text == i].tolist() == grams[want].tolist()


def test_seeds_are_shuffled_once_as_blocks(spark):
    docs = docs_of(spark, [(i, sentence(i, 400), "en", "a") for i in range(40)])
    blocks = substring_dedup.seeds(docs, 6, 4, 50, 16).collect()
    count = sum(len(words.unpacked_columns(b.block, substring_dedup.SEED)[0]) for b in blocks)
    assert count > 40 * 100 and sum(len(b.block) for b in blocks) < 14 * count
    assert all((words.unpacked_columns(b.block, substring_dedup.SEED)[0] % np.uint64(16) == b.bucket).all() for b in blocks)


@pytest.mark.parametrize("common", [1, 3, 1000])
def test_links_of_common_and_rare_seeds_are_the_same(spark, common):
    rng = np.random.default_rng(7)
    places = [(int(s), int(d), int(p)) for s, d, p in zip(rng.integers(0, 40, 400) ** 2 // 40, rng.integers(-3, 30, 400), rng.integers(0, 50, 400))] + [(99, -2 ** 63, 1), (99, 2 ** 63 - 1, 4)]
    want = set()
    for s, d, p in places:
        if earlier := [(x, y) for z, x, y in places if z == s and x < d]:
            previous = max(x for x, _ in earlier)
            want |= {(d, *min(earlier), p), (d, previous, min(y for x, y in earlier if x == previous), p)}
    # several blocks of a bucket
    seed, doc, pos = (np.array(c, dtype=t) for c, t in zip(zip(*places), substring_dedup.SEED))
    rows = [row for at in range(0, len(places), 30) for row in words.dealt_blocks((seed[at : at + 30] % np.uint64(4)).astype(np.int32), [c[at : at + 30] for c in (seed, doc, pos)])]
    blocks = substring_dedup.linked_blocks(spark.createDataFrame(rows, substring_dedup.BLOCKS_SQL), 3, 8, common).cache()
    found = blocks.where("bucket >= 0").union(substring_dedup._common_anchors(blocks, [5, 20], 8)).collect()
    got = [x for b in found for x in zip(*(c.tolist() for c in words.unpacked_columns(b.block, substring_dedup.ANCHOR)))]
    assert {(d, r, a, p) for d, r, p, a in got} == want
    assert (blocks.where("bucket = -1").count() > 0) == (common < 1000)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=12))
def test_words_around_chains_are_sent_once(anchors):
    found = [([p for p, _ in c], [r for _, r in c]) for c in substring_dedup.chains(anchors, 6)]
    assert substring_dedup.unfolded(substring_dedup.folded(substring_dedup.chains(anchors, 6))) == found
    parts = substring_dedup.stretches(found, 6)
    assert all(e < s for (_, e), (s, _) in zip(parts, parts[1:]))
    assert all(any(s <= lo and hi <= e for s, e in parts) for lo, hi in (substring_dedup.around(at, 6) for _, at in found))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=12))
def test_best_chain_against_brute_force(anchors):
    points = sorted(set(anchors))
    best = {}
    for p in points:
        best[p] = 8 + max([0.0] + [best[q] - 0.1 * (p[0] + p[1] - q[0] - q[1]) for q in points if q[0] < p[0] and q[1] < p[1]])
    first = substring_dedup.chains(anchors, 8)[0]
    score = 8 * len(first) - 0.1 * (sum(first[-1]) - sum(first[0]))
    assert abs(score - max(best.values())) < 1e-6


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=12), st.lists(st.sampled_from("abcd"), max_size=25))
def test_myers_against_dynamic_programming(pattern, text):
    row, best = list(range(len(pattern) + 1)), (len(pattern), 0)
    for j, w in enumerate(text, 1):
        new = [0]
        for i, x in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (x != w), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, (row[-1], j))
    assert decontaminate.myers(pattern, text) == best


def test_decontamination(spark, odd, none):
    item = sentence(50, 20).split()
    edited = [*item[:5], "new", *item[5:12], *item[13:18], "other", item[19]]
    rows = [(1, sentence(1, 50) + " " + " ".join(item).upper() + "! " + sentence(2, 9), "en", "a"), (2, " ".join(edited), "en", "a"),
            (3, sentence(3, 60) + " " + " ".join(item[:8]), "en", "a"), (4, None, "en", "a")]
    bench = spark.createDataFrame([(9, " ".join(item)), (8, None), (7, ""), (6, "lonely")], "item_id long, text string")
    docs = docs_of(spark, rows)
    for chars in (10, 10_000):  # in many blocks, in one
        got = {(r.doc_id, r.item_id, r.distance, r.start, r.end) for r in decontaminate.contaminated(docs, bench, block_chars=chars).collect()}
        assert got == {(1, 9, 0, 50, 70), (2, 9, 3, 0, 20)}
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4]
    assert decontaminate.clean_documents(odd, bench).count() == odd.count()
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.contaminated(odd, bench.limit(0)).count() == 0


def test_license_scan(spark, odd, none):
    rows = [(1, "Intro\nReleased under the MIT License.\nmore under the MIT license", "en", "a"),
            (2, "x This work is licensed under the GNU General Public License, version 3", "en", "a"),
            (3, "Apache License,\nVersion 2.0 and CC-BY-NC", "en", "a"), (4, "the license of this work", "en", "a"), (5, None, None, None)]
    docs = docs_of(spark, rows)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in license_scan.scan(docs).collect()}
    assert got == {1: (11, 2, 2, 7, "mit", "mit"), 2: (13, 0, None, None, "", "gpl-3"), 3: (9, 2, 0, 6, "apache-2,cc-by-nc", "apache-2,cc-by-nc"),
                   4: (5, 0, None, None, "", ""), 5: (0, 0, None, None, "", "")}
    blocks = {(r.doc_id, r.block, r.label) for r in license_scan.license_blocks(docs).collect()}
    brute = set()
    for i, t, _, _ in rows:
        for n, line in enumerate((t or "").encode().split(b"\n")):
            own = set(license_scan.block_words(line))
            brute |= {(i, n, label) for label, ws in license_scan.template_sets() if len(own & ws) >= 0.8 * len(ws)}
    assert blocks == brute
    assert license_scan.scan(odd).count() == odd.count() and license_scan.scan(none).count() == 0


def test_wrapped_license_templates_are_found(spark):
    texts = {"mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
             "bsd-3": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
             "mpl-2": "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0.",
             "gpl-3": "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU General\n// Public License"}
    rows = [(i, f"{sentence(i, 40)}\n{t}\n{sentence(i, 30)}", "en", "a") for i, t in enumerate(texts.values())]
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs_of(spark, rows)).collect()}
    assert got == {i: (label, 1.0) for i, label in enumerate(texts)}
    assert {(r.doc_id, r.block, r.label) for r in license_scan.license_blocks(docs_of(spark, rows)).collect()} == {(i, 1, label) for i, label in enumerate(texts)}
    # words of a template that are scattered over a long line are none
    far = " ".join(f"{w} {sentence(7, 20)}" for w in "released under the mit license".split())
    assert license_scan.scan(docs_of(spark, [(1, far, "en", "a")])).first().labels == ""


def test_licenses_of_nearly_the_same_words_are_told_apart(spark):
    cc = "This work is licensed under a Creative Commons Attribution-"
    want = {"Released under the Apache License.": "", "Released under the GPL License": "", "Licensed under CC BY 4.0": "", "Licensed under CC BY-SA 4.0": "",
            cc + "ShareAlike 4.0 International License.": "cc-by-sa", cc + "NonCommercial 4.0 International License.": "cc-by-nc",
            cc + "NonCommercial-ShareAlike 4.0 International License.": "", "Licensed under the Eclipse Public License, Version 2.0": "",
            "Licensed under the Apache License, Version 1.0": "", "Licensed under the Apache License 2.0": "apache-2",
            "This work is licensed under the GNU General Public License, version 2.": "", "Licensed under CC BY-NC 4.0": "cc-by-nc",
            "This work is licensed under the GNU Lesser General Public License, version 3.": "", "x under the MIT license": "mit",
            "This work is licensed under the GNU General Public License, version 3.": "gpl-3"}
    rows = [(i, t, "en", "a") for i, t in enumerate(want)]
    got = {rows[r.doc_id][1]: r.labels for r in license_scan.scan(docs_of(spark, rows)).collect()}
    assert got == want


def test_every_template_meets_itself():
    ready = license_scan.Templates(license_scan.TEMPLATES, {}, license_scan.THRESHOLD)
    for label, text in license_scan.TEMPLATES:
        met = [(x, c) for x, _, c in ready.meets(license_scan.block_words(text.encode()))]
        assert {x for x, _ in met} == {label} and max(c for _, c in met) == 1.0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"x"]), max_size=14), st.integers(1, 6))
def test_windows_against_brute_force(stream, longest):
    own = frozenset([b"a", b"b", b"c"])
    got = list(license_scan.windows(stream, own, longest))
    ends = [i for i, w in enumerate(stream) if w in own]
    want = [own & set(stream[max(0, i - longest + 1):i + 1]) for i in ends]
    assert [n for _, n in got] == [len(x) for x in want]
    assert all(own & set(stream[f:i + 1]) == x and own & set(stream[f + 1:i + 1]) != x for (f, _), i, x in zip(got, ends, want))


def test_chat_folds_events_and_reads_back(spark):
    schema = "conv_id long, seq long, msg long, kind string, role string, text string"
    events = spark.createDataFrame([
        (1, 1, 1, "message", "user", "hi <|end|>\n"), (1, 2, 2, "message", "assistant", "a"), (1, 3, 2, "delta", None, "b"), (1, 4, 3, "message", "user", "&lt;"),
        (1, 5, 2, "edit", None, "new"), (1, 6, 2, "delta", None, "er"), (1, 7, 4, "message", "assistant", "bad"), (1, 8, 4, "regenerate", None, "good"),
        (None, 1, 1, "message", None, None), (2, 1, 1, "delta", "assistant", "only")], schema)
    chats = chat_format.formatted(events)
    back = {r.conv_id: ([tuple(t) for t in r.turns], r.loss) for r in chat_format.read_back(chats).collect()}
    assert back == {1: ([("user", "hi <|end|>\n"), ("assistant", "newer"), ("user", "&lt;"), ("assistant", "good")], "newergood"),
                    None: ([("", "")], ""), 2: ([("assistant", "only")], "only")}
    for r in chats.collect():  # absolute places as well
        for s in r.loss_spans:
            assert r.formatted[s.start - 1:s.start] == "\n" and r.formatted[s.start + s.length:].startswith("<|end|>")
    assert chat_format.formatted(events.limit(0)).count() == 0


def test_chat_digests(spark):
    rows = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", "[x]"), (1, 1, "assistant", "[x]")], "conv_id long, turn long, role string, text string")
    r = {x.conv_id: x for x in chat_format.digests(chat_format.formatted(chat_format.conversation_events(chat_format.with_probe(rows)))).collect()}
    assert r[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\n[x]\nassistant\n[x]\n").hexdigest() and r[1].loss_chars == 6
    assert r[-7].n_turns == 2 and r[-7].loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()


def test_languages_on_held_out_documents(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.languages(docs, per_language=60).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.where("lang_pred = lang").count(), got.count()
    assert n > 100 and right >= 0.97 * n
    out = language_id.languages(odd).collect()
    assert len(out) == odd.count() and all(r.lang_pred == "und" and r.score == 0 for r in out if r.doc_id in (1, 2, 7))
    assert language_id.languages(none).count() == 0


def test_quality_classifier(spark, odd, none):
    rows = [(i, sentence(i, 100), "en", f"s{i % 4}") for i in range(200)] + [(1000 + i, sentence(i, 100).replace(" ", "### "), "en", "bad") for i in range(60)]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, *_ in rows if i % 2] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_classifier.quality_posteriors(docs, labels, docs["source"], docs["lang"]).collect()}
    assert all(got[i].kept for i in range(200)) and not any(got[1000 + i].kept for i in range(60))
    assert got[1000].path_rate < 0.2 < 0.9 < got[1].path_rate
    empty = labels.limit(0)
    assert {r.quality for r in quality_classifier.quality_posteriors(odd, empty, odd["source"], odd["lang"]).collect()} == {0.5}
    assert quality_classifier.quality_posteriors(none, labels, none["source"], none["lang"]).count() == 0


def test_groups_across_batches():
    batches = [pa.RecordBatch.from_pydict({"k": [1, 1], "v": [1, 2]}), pa.RecordBatch.from_pydict({"k": [1, 2], "v": [3, 4]})]
    assert list(words.grouped(batches, 1)) == [((1,), [(1,), (2,), (3,)]), ((2,), [(4,)])]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    here = "/root/testdata/sf0.001"
    assert digest(queries.QUERIES[name](spark, here).toPandas()) == digest(duck(here).execute(queries.SQL[name]).df())


@pytest.mark.parametrize("sql", ["quality_rules", "ngram_join", "license_scan"])
def test_sql_on_odd_rows(odd, sql):
    import duckdb

    operator = {"quality_rules": quality_rules.quality_verdicts, "license_scan": license_scan.scan,
                "ngram_join": lambda d: ngram_join.near_duplicates(d).drop("text_hash")}[sql]
    rows = odd.where("doc_id is not null").dropDuplicates(["doc_id"]) if sql == "ngram_join" else odd  # its SQL reads ids as keys
    con = duckdb.connect()
    con.register("documents", rows.toArrow())
    assert digest(operator(rows).toPandas()) == digest(con.execute(getattr(oracle, sql)()).df())
