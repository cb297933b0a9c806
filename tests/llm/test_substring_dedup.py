from __future__ import annotations

import random

from hypothesis import given, strategies as st

from agora.llm import substring_dedup as sd


@given(st.text(alphabet="ab.!?\n \t。é", max_size=60))
def test_sentences_join_to_the_text(text):
    assert "".join(sd.sentences(text)) == text


def brute(docs):
    """Kept text per (id, text) from all runs, of any number of sentences, in order of first occurrence."""
    seen, out = {}, {}
    distinct = sorted({(i, t or "") for i, t in docs},
                      key=lambda r: (r[0] is not None, r[0] or 0))
    runs = []
    for n, (i, text) in enumerate(distinct):
        pieces = sd.sentences(text)
        words = [sd.length(s) for s in pieces]
        for at in range(len(pieces)):
            for k in range(1, len(pieces) - at + 1):
                size = sum(words[at:at + k])
                if size >= sd.RUNS.get(k, 20) and (
                        k < 4 or min(size - words[at], size - words[at + k - 1]) < 20):
                    runs.append((n, at, k, tuple(s.strip(sd.WHITE) for s in pieces[at:at + k])))
    gone = set()
    for n, at, k, key in sorted(runs, key=lambda r: r[:2]):
        if seen.setdefault(key, (n, at)) != (n, at):
            gone |= {(n, at + x) for x in range(k)}
    for n, (i, text) in enumerate(distinct):
        out[i, text] = "".join(s for x, s in enumerate(sd.sentences(text)) if (n, x) not in gone)
    return out


def fixture():
    rng = random.Random(9)
    sentence = lambda: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(rng.randrange(40))
                                for _ in range(rng.randint(3, 14))) + rng.choice([". ", "! ", ".\n"])
    passage = "".join(sentence() for _ in range(8))
    docs = []
    for i in range(60):
        own = [sentence() for _ in range(rng.randint(1, 10))]
        if i % 3 == 0:
            own.insert(rng.randint(0, len(own)), "\n" + passage)
        docs.append((i, "".join(own)))
    docs += [(100, docs[1][1] * 2), (101, docs[4][1]), (102, None), (103, ""), (102, "x"),
             (104, "word " * 60), (105, "word " * 60), (106, "Short. One. Two."),
             (107, "Short. One. Two."), docs[3]]
    return docs


def test_dedup(spark):
    docs = fixture()
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in docs],
                               "doc_id long, text string, row int, spans string").repartition(3)
    got = sd.dedup(df).collect()
    want = brute(docs)
    assert len(got) == len(docs)
    assert sorted((r.doc_id, r.text) for r in got) == sorted(
        (i, want[i, t or ""]) for i, t in docs)
    by_id = {r.doc_id: r for r in got}
    assert by_id[101].text == by_id[105].text == "" and by_id[105].removed == "0:300"
    assert by_id[107].text == "Short. One. Two."
    assert sum(r.n_removed for r in got) > 100


def test_null_ids_and_empty(spark):
    text = fixture()[0][1]
    df = spark.createDataFrame([(None, text), (5, text)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in sd.dedup(df).collect()} == {None: text, 5: ""}
    assert sd.dedup(df.limit(0)).count() == 0


def test_hot_hashes_are_salted_with_the_same_result(spark, monkeypatch):
    docs = fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(sd, "HOT", 20)
    want = brute(docs)
    assert sorted((r.doc_id, r.text) for r in sd.dedup(df).collect()) == sorted(
        (i, want[i, t or ""]) for i, t in docs)


def long_brute(words):
    """(first, sentences) of the runs of more than six that lose their 20 words without an end."""
    return sorted((i, k) for i in range(len(words)) for k in range(7, len(words) - i + 1)
                  if sum(words[i:i + k]) >= 20
                  and (sum(words[i:i + k - 1]) < 20 or sum(words[i + 1:i + k]) < 20))


@given(st.lists(st.integers(0, 6), max_size=60))
def test_long_runs(words):
    total = [sum(words[:i]) for i in range(len(words) + 1)]
    got = sd.long_runs(total)
    assert sorted(got) == long_brute(words)
    assert len(got) <= 2 * len(words)


def test_short_sentences_and_scripts_without_spaces(spark):
    rng = random.Random(3)
    new = lambda: "w" + str(rng.randrange(10**9))
    menu = "".join(" ".join(new() for _ in range(1 + i % 3)) + rng.choice([".\n", "!! ", "\n"])
                   for i in range(30))                                 # 60 words
    shout = "".join(f"{new()}!! " for _ in range(150))
    han = "".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(30)) + "。"
                  for _ in range(4))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(300))
    own = lambda: " ".join(new() for _ in range(30)) + ".\n"
    docs = [(0, menu), (1, menu), (2, shout), (3, shout), (4, han), (5, han), (6, thai), (7, thai)]
    before, after = own(), own()
    docs += [(8, before + menu + after), (9, before + shout[:600]), (10, "One. Two. Three.\n" * 3),
             (11, "One. Two. Three.\n" * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in sd.dedup(df).collect()}
    assert [got[i] for i in (0, 2, 4, 6)] == [menu, shout, han, thai]
    assert [got[i] for i in (1, 3, 5, 7)] == [""] * 4
    assert got[8] == before + after and got[9].startswith(before)
    assert len(got[9]) < len(before) + 15                             # what was cut within a word
    assert got[10] == got[11] == docs[10][1]                          # under 20 words stay
    want = brute(docs)
    assert all(got[i] == want[i, t] for i, t in docs)


def test_sql_states_the_same_rule(spark):
    """Long runs, scripts without spaces, repeats inside a text."""
    import duckdb

    rng = random.Random(8)
    pool = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randint(0, 4))) + rng.choice([".\n", "! ", "\n"])
            for _ in range(12)] + ["漢字" * 9 + "。", "กขค" * 20 + "\n"]
    docs = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(40)]
    docs += [(40, None), (41, ""), (42, docs[3][1] * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.execute(sd.SQL).fetchall()
    assert sorted(map(tuple, sd.dedup(df).collect())) == sorted(want)
    kept = brute(docs)
    assert all(text == kept[i, dict(docs)[i] or ""] for i, _, _, _, text in want)
