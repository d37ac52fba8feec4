import random

import pytest

from tallyhawk.llm import blocks

SCHEMA = "doc_id long, text string, uid int, data string, places int"


def plain(rows, window):
    """[(id, words that stay, runs)]: every window looked up in all smaller documents."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = {}, []
    for i in order:
        rank = (rows[i][0] is None, rows[i][0] or 0)
        words = (rows[i][1] or "").encode().split()
        mask = [False] * len(words)
        for p in range(len(words) - window + 1):
            w = tuple(words[p:p + window])
            if seen.setdefault(w, rank) < rank:
                mask[p:p + window] = [True] * window
        runs = sum(m and not (j and mask[j - 1]) for j, m in enumerate(mask))
        out.append((rows[i][0], b" ".join(w for w, m in zip(words, mask, strict=True) if not m).decode(), len(words), runs))
    return out


def texts(seed):
    rng = random.Random(seed)
    words = ["the", "of", "été", "and", "stone", "river", "日本", "x" * 40]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(n))
    shared = [say(40), say(14), say(25), say(13), "a common line of exactly seven words here", say(9)]
    out = [say(60), "la " * 80, "la " * 12, "la " * 14, say(3), "", None, " \t\n ", "a b " * 13, "a b  " * 13]
    for _ in range(80):
        out.append("\n ".join([say(rng.randrange(12)), rng.choice(shared), say(rng.randrange(12)),
                               " ".join(rng.choice(shared).split()[rng.randrange(9):]), rng.choice(shared)]))
    copy = say(120).split()
    out += [" ".join(x) for x in (copy, copy, [*copy[:50], "!", *copy[50:]], copy[5:], copy[:12], copy[:13])]
    return [(i * 7 % 1000, t) for i, t in enumerate(out)]


def run(spark, rows, parts=5, **options):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(parts)
    out, c = blocks.remove_repeated(docs, **options)
    assert out.columns[:4] == ["doc_id", "uid", "data", "places"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    return sorted(((r["doc_id"], r[c["kept"]], r[c["n_words"]], len(r[c["removed"]])) for r in out.collect()), key=key), key


@pytest.mark.parametrize("piece", [60, 900, 1 << 22])
@pytest.mark.parametrize("window", [13, 4, 1])
def test_as_brute_force(spark, monkeypatch, piece, window):
    """Pieces of one text, of few and of all; blocks of 7, 2 and 1 words."""
    monkeypatch.setattr(blocks, "PIECE_BYTES", piece)
    rows = texts(window)
    got, key = run(spark, rows, window=window)
    assert got == sorted(plain(rows, window), key=key)


def test_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(None, a), (None, a), (2, b), (2, b), (2, a), (5, a + " " + b), (9, a + " c " + a), (None, b + " end")]
    got, key = run(spark, rows)
    assert got == sorted(plain(rows, 13), key=key)
    assert [r[1] for r in got] == [a, b, b, "", "c", "", "", "end"]


def test_repeats_inside_one_document_stay(spark):
    a = " ".join(f"a{i}" for i in range(20))
    got, _ = run(spark, [(1, f"{a} {a} {a}"), (2, "other words")])
    assert got[0][1] == f"{a} {a} {a}"


def test_no_rows(spark):
    got, _ = run(spark, [])
    assert got == []


def test_many_copies_send_one_entry_per_piece(spark):
    """A block that all texts of a piece share is one entry."""
    import pyarrow as pa
    text = " ".join(f"w{i}" for i in range(40)).encode()
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array([text] * 500, pa.binary())], ["uid", "data"])
    from unittest import mock
    with mock.patch.object(blocks, "TaskContext") as task:
        task.get().partitionId.return_value = 0
        rows = [r for b in blocks._index(13, 4)(iter([batch])) for r in b.to_pylist()]
    assert sum(len(r["a"]) // 4 for r in rows if r["kind"] == blocks.ENTRIES) == 34
