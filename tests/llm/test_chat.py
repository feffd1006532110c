from collections import defaultdict

from holdwright.llm import chat

COLS = ["conv_id", "perspective", "part", "n_turns", "start", "text"]


def brute(rows, size):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((-1 if t is None else t, r or "unknown", (x or "").replace("<|", "< |")))
    out = []
    for c, turns in convs.items():
        for who in {r for _, r, _ in turns if r != "system"}:
            at = 0
            for part in range(-(-len(turns) // size)):
                some = sorted(turns)[part * size : (part + 1) * size]
                text, mask = "", []
                for _, r, x in some:
                    text += "<|assistant|>\n" if r == who else "<|system|>\n" if r == "system" else f"<|user {r.replace('<|', '< |')}|>\n"
                    begin = at + len(text)
                    text += x + "<|end|>\n"
                    if r == who:
                        mask.append((begin, at + len(text)))
                out.append((c, who, part, len(some), at, text, mask))
                at += len(text)
    return sorted(out, key=str)


def got(df):
    return sorted(((*(r[c] for c in COLS), [tuple(s) for s in r["mask"]]) for r in df.collect()), key=str)


def test_conversations(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(chat.rotate(turns)) == brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()], chat.PART)


def test_odd(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 4)
    rows = [(1, k, f"p{k % 3}", f"turn {k} é<|end|>") for k in range(30)] + [
        (1, 2, "p2", None), (None, 0, "user", "x"), (None, 0, "user", "x"), (2, 0, "system", "only"), (3, None, None, "a"), (3, 1, "a<|b", "b"), (4, 5, "user", ""),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, start int")
    assert got(chat.rotate(df)) == brute(rows, 4)
    assert chat.rotate(df.limit(0)).count() == 0


def test_many_rows_of_one_turn(spark, monkeypatch):
    """Null and repeated turn numbers, equal rows, a null conversation, and a text of a million characters."""
    some = [(c, t, f"p{k % 2}", f"text {k % 7}") for c, t, n in ((1, None, 40), (1, 3, 25), (None, 0, 30), (2, 9, 3)) for k in range(n)]
    some.append((2, 10, "p0", "long é " * 150_000))
    df = spark.createDataFrame([(*r, "x") for r in some], "conv_id long, turn long, role string, text string, lot string").repartition(5)
    monkeypatch.setattr(chat, "PART", 8)
    assert got(chat.rotate(df)) == brute(some, 8)
