"""All five stages of the corpus pipeline on a small corpus with planted cases, each against brute force."""

import collections

import numpy as np

import corpus_pipeline
from stratum.llm import tokens


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))


def edited(text, places):
    return " ".join(f"new{i}" if i in places else w for i, w in enumerate(text.split()))


def corpus():
    item, fuzzy = sentence(900, 20), sentence(901, 80)
    rows = {i: sentence(i, 120) for i in range(1, 7)}
    rows[10] = rows[1]  # exact copy
    rows[11] = edited(rows[2], {60})  # near copy
    rows[12] = f"{sentence(12, 70)} {fuzzy} {sentence(13, 40)}"
    rows[13] = f"{sentence(14, 60)} {edited(fuzzy, set(range(7, 80, 10)))} {sentence(15, 90)}"  # 10% edits
    rows[14] = f"{sentence(16, 50)} {rows[3]} {sentence(17, 60)}"  # an exact passage
    rows[15] = f"{sentence(18, 70)} {item} {sentence(19, 40)}"
    rows[16] = f"{sentence(20, 70)} {edited(item, {4, 11})} {sentence(21, 40)}"
    rows[17] = f"{sentence(22, 70)} {edited(item, {1, 4, 7, 10, 13, 16})} {sentence(23, 40)}"  # too many edits
    rows[20] = sentence(24, 30)  # too short
    rows[21] = sentence(25, 120).replace(" ", " ### ")  # symbols
    rows[22] = " ".join([sentence(26, 10)] * 12)  # repeats
    return rows, item


def rejected(text, symbol_fence):
    w = text.split()
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(w) < 50 or 2 * len(covered) > len(w) or text.count("#") > symbol_fence * len(w)


def one_of_each(docs):
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in docs.items()}
    group = {i: i for i in docs}
    for _ in docs:
        for i in docs:
            group[i] = min(group[j] for j in docs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    return {i: t for i, t in docs.items() if group[i] == i}


def repeated(a, b):
    """Best-scoring local alignment (match 1, edit -2) of b's words to a stretch of a: (start, end, matched) in b."""
    best, above = (0, 0, 0, 0), [(0, 0, 0)] * (len(a) + 1)
    for i, x in enumerate(b):
        row = [(0, i + 1, 0)]
        for j, y in enumerate(a):
            (s, start, m), up, left = above[j], above[j + 1], row[j]
            if x == y:
                cell = (s + 1, start if s > 0 else i, m + 1)
            else:
                cell = max((s - 2, start, m), (up[0] - 2, up[1], up[2]), (left[0] - 2, left[1], left[2]))
            row.append(cell if cell[0] > 0 else (0, i + 1, 0))
            if cell[0] > best[0]:
                best = (cell[0], cell[1], i + 1, cell[2])
        above = row
    return best[1:]


def without_passages(docs):
    out = {}
    for i, t in docs.items():
        w, drop = t.split(), set()
        for j in (j for j in docs if j < i):
            s, e, m = repeated(docs[j].split(), w)
            if e - s >= 50 and m >= 0.8 * (e - s):
                drop |= set(range(s, e))
        if len(drop) < len(w):
            out[i] = " ".join(x for k, x in enumerate(w) if k not in drop)
    return out


def stands_in(item, text):
    row, best = list(range(len(item) + 1)), len(item)
    for w in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i - 1] + (x != w), row[i] + 1, new[i - 1] + 1))
        row, best = new, min(best, new[-1])
    return best <= len(item) // 5


def test_stages_against_brute_force(spark, tmp_dir):
    texts, item = corpus()
    spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    want = [{i: t for i, t in texts.items() if not rejected(t, 0.2)}]
    want.append(one_of_each(want[-1]))
    want.append(without_passages(want[-1]))
    want.append({i: t for i, t in want[-1].items() if not stands_in(item.split(), t.split())})
    # every stage has something to do
    assert set(texts) - set(want[0]) == {20, 21, 22} and set(want[0]) - set(want[1]) == {10, 11} and set(want[2]) - set(want[3]) == {15, 16}
    assert {i for i, t in want[2].items() if t != texts[i]} == {13, 14}
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want):
        columns, docs = docs.columns, stage(spark, docs, tmp_dir)
        got = {r.doc_id: (" ".join(r.text.split()), r.n_chars) for r in docs.collect()}
        assert docs.columns == columns and {i: t for i, (t, _) in got.items()} == expected, name
    pieces = corpus_pipeline.run(spark, tmp_dir).collect()
    t, length = tokens.word_tokenizer(tokens.default_vocabulary()), collections.Counter()
    for r in pieces:
        length[r.doc_id] += r.length
    assert dict(length) == {i: len(t.tokenizer.encode(x, add_special_tokens=False).ids) + 1 for i, x in want[3].items()}
