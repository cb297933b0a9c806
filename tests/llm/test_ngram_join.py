from __future__ import annotations

import random
import re

import pytest

from agora.llm import ngram_join


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)}


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    links = [[] for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                links[i].append(j), links[j].append(i)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((str(doc_id), len(sets[i]), str(min(ids, default=None)), len(links[i])))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    passage, base = text(25), text(60)
    docs = []
    for _ in range(25):
        docs.append(text(rng.randint(1, 80)))
    for _ in range(40):                                    # near copies of one text
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 1)] = text(rng.randint(0, 1))
        docs.append(w)
    for _ in range(40):                                    # one passage in different texts
        docs.append(passage + text(rng.randint(0, 40)))
    chain = text(80)                                       # links that are not transitive
    for _ in range(12):
        at = rng.randrange(len(chain))
        chain = chain[:at] + text(2) + chain[at + 2:]
        docs.append(list(chain))
    for w in rng.sample(docs, 12):                         # copies, and copies in other case
        docs.append(list(w)), docs.append([x.upper() for x in w])
    rows = [(i * 3 % 1009, " ".join(w)) for i, w in enumerate(docs)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "one two"), (2004, "One  two"),
             (None, rows[30][1]), (rows[2][0], rows[2][1]), (2005, "x " * 5000), (2006, "x " * 9)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 85), (3, 70)])
def test_join(spark, seed, percent):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                               "doc_id long, text string, c int, tokens string").repartition(3)
    got = ngram_join.join(df, percent=percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links)
                  for r in got) == brute(rows, percent)


def test_frequent_list_does_not_change_links(spark, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.join(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links)
                  for r in got) == brute(rows, 85)


def test_word_hashes():
    from agora.llm.common import word_hashes

    rng = random.Random(8)
    vocab = ["a", "b", "ab", "ba", "aa", "aaa", "é", "w" * 300, "\x00", "\x00\x00"]
    texts = [" ".join(rng.choice(vocab) + rng.choice(["", "\t", "\n \r"])
                      for _ in range(rng.randint(0, 30))) for _ in range(200)] + ["", " \n"]
    hashes, counts = word_hashes([t.encode() for t in texts])
    words = [w for t in texts for w in t.encode().split()]
    assert counts.tolist() == [len(t.encode().split()) for t in texts]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    assert word_hashes([])[1].tolist() == [] and word_hashes([b""])[1].tolist() == [0]


def test_long_lists_are_left_out_with_the_same_result(spark, monkeypatch):
    rows = corpus(6)
    monkeypatch.setattr(ngram_join, "LONG", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.join(df, percent=75).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links)
                  for r in got) == brute(rows, 75)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(df).count() == 0


def test_representatives(spark):
    rows = corpus(5)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                               "doc_id long, text string, row int, root string")
    kept = ngram_join.representatives(df, words=4, percent=85)
    assert kept.columns == df.columns
    got = kept.collect()
    full = brute(rows, 85)
    with_words = {(d, c) for d, n, c, _ in full if n}
    assert {str(r.doc_id) for r in got if shingle_set(r.text)} == {c for _, c in with_words}
    assert len([r for r in got if shingle_set(r.text)]) == len({c for _, c in with_words})
    assert sorted(r.doc_id for r in got if not shingle_set(r.text)) == [2000, 2001, 2002]


def test_a_wide_group_makes_few_pairs(spark, monkeypatch):
    """500 copies with edits far apart (median Jaccard about 0.6): links are right, and pairs
    are made where edits coincide, not for all."""
    rng = random.Random(21)
    base = [f"b{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 500):
        w = list(base)
        for at in rng.sample(range(300), rng.choice([1, 2, 8, 9, 10, 11])):
            w[at] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    sets = [shingle_set(t) for _, t in rows]
    sample = sorted(len(sets[a] & sets[b]) / len(sets[a] | sets[b])
                    for a, b in (rng.sample(range(500), 2) for _ in range(400)))
    assert 0.5 < sample[200] < 0.75
    made = []
    plain = ngram_join.written

    def counted(df):
        out = plain(df)
        if {"z", "y_c", "p"} & set(out.columns):
            made.append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "written", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.join(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links)
                  for r in got) == brute(rows, 85)
    # of 124,750 pairs: those of members whose minimum hashes miss the leader, and a few
    assert max(made) * 8 < 500 * 499 // 2


def test_members_that_miss_their_leader_make_no_pairs_with_its_group(spark, monkeypatch):
    """400 copies near one text, some of which miss it by their minimum hashes: their
    links with the others are counted, not compared one by one."""
    rng = random.Random(22)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        w = list(base)
        for at in rng.sample(range(200), rng.choice([4, 5, 6, 7])):
            w[at] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    made = []
    plain = ngram_join._difference

    def counted(pairs, sets, a, b, out):
        if a == "y_c":
            made.append(pairs.count())
        return plain(pairs, sets, a, b, out)
    monkeypatch.setattr(ngram_join, "_difference", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.join(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links)
                  for r in got) == brute(rows, 85)
    assert sum(made) < 2000


def test_column_names_with_dots(spark):
    rows = corpus(7)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, `a.b` int")
    assert ngram_join.representatives(df, words=4, percent=85).columns == ["doc_id", "text", "a.b"]


def test_representatives_make_the_digests_once(spark, capsys):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, ""), (3, ""), (4, None), (None, "g h"), (5, " ")]
    kept = ngram_join.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    kept.explain()
    plan = capsys.readouterr().out
    # one grouping of linked rows and rows without a word; twice in the branches of a union before
    assert plan.count("MapInArrow") == 1
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert got == [("1", "a b c d e f"), ("3", ""), ("4", ""), ("5", " "), ("None", "g h")]


def test_whole_sets_are_made_of_the_wanted_texts_only(spark, monkeypatch, tmp_path):
    rng = random.Random(23)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for i in range(200)]
    near = rows[0][1].split()
    near[30] = "other"
    rows += [(200, " ".join(near)), (201, rows[0][1]), (202, rows[0][1].upper())]
    plain, folder = ngram_join._each_set, str(tmp_path)

    def counted(batch, n):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("x" * batch.num_rows)
        return plain(batch, n)
    monkeypatch.setattr(ngram_join, "_each_set", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.join(df, percent=80).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links)
                  for r in got) == brute(rows, 80)
    made = sum(f.stat().st_size for f in tmp_path.iterdir())
    # shingle counts, signatures and digests of all; whole sets of a few (of all before: 812)
    assert 3 * len(rows) <= made < 3 * len(rows) + 40


def test_word_hashes_of_any_length_are_alike():
    import numpy as np
    from agora.llm import common

    words = [b"a", b"bc", b"def" * 9]
    alone = [common.word_hashes([w])[0][0] for w in words]
    for times in (1, 40, 60_000):                  # within and beyond the powers that are kept
        hashes, counts = common.word_hashes([b" ".join(words * times), b"", b"bc"])
        assert counts.tolist() == [3 * times, 0, 1]
        assert np.array_equal(hashes, np.array([*alone * times, alone[1]]))
    assert len(common._kept_powers[0]) <= common._POWERS_KEPT
