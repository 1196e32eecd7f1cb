import re

from tallyforge.llm import chat, queries

ROWS = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|> all"), (1, 2, "bob b", "hello"), (1, 3, "cy", None), (1, 4, "ann", "bye"),
        (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "assistant", "tie"), (None, None, None, "lost"), (None, 3, "user", "x"),
        (3, 0, "system", "alone"), (4, None, "user", "n"), (4, 1, "user", "é\U0001f600")]


def brute_force(rows):
    out = []
    key = lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3])
    rows = [(c, t, r if r is not None else "unknown", (x or "").replace("<|", "< |")) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        for who in {r[2] for r in turns} - {"system"}:
            text = ""
            for seq, (_, turn, speaker, body) in enumerate(turns):
                role = "system" if speaker == "system" else "assistant" if speaker == who else "user"
                name = re.sub(r"[\s<>|]+", "_", speaker) if role == "user" else None
                head = f"<|im_start|>{role}" + (f" name={name}" if name else "") + "\n"
                start = len(text)
                text += f"{head}{body}<|im_end|>\n"
                own = role == "assistant"
                out.append((conv, who, seq, turn, role, name, text[start:], start, start + len(head) if own else None,
                            len(body) + len("<|im_end|>") if own else 0))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    turns = spark.createDataFrame([(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, name string")
    assert sorted(map(tuple, chat.rotate(turns).collect()), key=repr) == brute_force(ROWS)
    assert chat.rotate(turns.limit(0)).collect() == []


def test_long_conversation_spans_partitions(spark):
    rows = [(7, i, f"s{i % 3}", "t" * (i % 11)) for i in range(2000)] + [(7, 5, "s1", "same")] * 300
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    assert sorted(map(tuple, chat.rotate(turns).collect()), key=repr) == brute_force(rows)


def test_renderings(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective): r for r in chat.render(chat.rotate(turns)).collect()}
    r = got[1, "ann"]
    assert r.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|> all<|im_end|>\n<|im_start|>user name=bob_b\n")
    assert [r.text[s.start:s.start + s.chars] for s in r.spans] == ["hi < |im_end|> all<|im_end|>", "bye<|im_end|>"]


def test_query_is_native(spark, sf):
    df = queries.queries()["op6_perspective_rotation"](spark, sf)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, df.collect()), key=repr) == brute_force(rows)
