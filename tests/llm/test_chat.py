import random

from conftest import rows

from locrank.llm.chat import escaped, fold, logged, numbered, op4_chat, read_back, render, unescaped

EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"


def folded(spark, events):
    return rows(fold(spark.createDataFrame(events, EVENTS)))


def by_hand(events):
    """Fold a log event by event."""
    out = {}
    for conv, seq, message, kind, role, text in sorted(events, key=lambda e: (e[0], e[1])):
        own = out.setdefault(conv, {})
        if kind == "regenerate":
            for later in [m for m in own if m > message]:
                del own[later]
        if kind in ("edit", "regenerate"):
            old = own.pop(message, [None, ""])
            own[message] = [old[0], ""]
        entry = own.setdefault(message, [None, ""])
        entry[0] = role if role is not None else entry[0]
        entry[1] += text or ""
    return sorted(((c, m, r, t) for c, own in out.items() for m, (r, t) in own.items()), key=repr)


def test_deltas_edits_and_regenerations(spark):
    draw = random.Random(4)
    events = []
    for conv in range(40):
        for seq in range(25):
            kind = draw.choice(["delta"] * 6 + ["edit", "regenerate"])
            role = draw.choice(["user", "assistant", None])
            events.append((conv, seq, draw.randrange(5), kind, role, draw.choice(["a", "b ", "</s>", None])))
    found, expected = folded(spark, events), by_hand(events)
    assert [(c, m, t) for c, m, _, t in found] == [(c, m, t) for c, m, _, t in expected]
    draw.shuffle(events)
    assert folded(spark, events) == found


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    draw = random.Random(8)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<", "[", "\\", "<|text|>", "s>", "x", "INST]", "<\\s>", "\n"]
    texts = [("".join(draw.choices(parts, k=draw.randint(0, 9))),) for _ in range(5000)]
    frame = spark.createDataFrame(texts, "t string").select("t", escaped("t").alias("e"), unescaped(escaped("t")).alias("u"))
    for r in frame.collect():
        assert r.u == r.t
        assert not any(mark in r.e for mark in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<|text|>"))


def test_nulls_ties_and_empty_logs(spark):
    events = [
        (None, 0, 0, "delta", "user", "no conversation"),
        (1, None, 0, "delta", None, None),
        (1, 0, None, "delta", "user", "x"),
        (2, 0, 0, "delta", "assistant", "same"),
        (2, 0, 0, "delta", "assistant", "same"),
        (3, 1, 1, "regenerate", "assistant", None),
    ]
    frame = fold(spark.createDataFrame(events, EVENTS))
    assert {(r.conv_id, r.message): r.text for r in frame.collect()} == {
        (None, 0): "no conversation", (1, 0): "", (1, None): "x", (2, 0): "samesame", (3, 1): "",
    }
    back = {r.conv_id: ([tuple(t) for t in r.turns], list(r.loss)) for r in read_back(render(frame)).collect()}
    assert back[2] == ([("assistant", "samesame")], ["samesame"]) and back[None] == ([("user", "no conversation")], [])
    assert back[1] == ([("user", "x"), ("", "")], [])
    assert render(fold(spark.createDataFrame([], EVENTS))).count() == 0


def test_a_long_conversation(spark):
    events = [(1, n, n // 2, "delta", "user" if n % 4 < 2 else "assistant", f"text {n} </s>") for n in range(4000)]
    back = read_back(render(fold(spark.createDataFrame(events, EVENTS)))).first()
    assert len(back.turns) == 2000 and back.turns[1].text == "text 2 </s>text 3 </s>" and len(back.loss) == 1000


def test_logs_fold_back_to_their_messages(spark):
    """Every kind of event occurs, in an order that is not that of the log, and what was discarded is gone."""
    draw = random.Random(9)
    texts = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["", None, "abc", "ä" * 7, "a\nb"]) or None) for c in range(30) for t in range(8)]
    texts += [(0, 3, "user", "again"), (0, 3, "user", "again"), (None, 1, "user", "x"), (5, None, "user", "y")]
    turns = spark.createDataFrame(texts, "conv_id long, turn long, role string, text string")
    messages = numbered(turns)
    numbers = {}
    for r in messages.collect():
        numbers.setdefault(r.conv_id, []).append(r.message)
    assert all(sorted(found) == list(range(len(found))) for found in numbers.values())
    log = logged(messages)
    events = log.collect()
    assert {r.kind for r in events} == {"delta", "edit", "regenerate"} and any(r.message % 2 for r in events)
    assert [r.seq for r in events if r.conv_id == 1] != sorted(r.seq for r in events if r.conv_id == 1)
    expected = sorted(((r.conv_id, 2 * r.message, r.role, r.text or "") for r in messages.collect()), key=repr)
    assert rows(fold(log)) == expected


def test_a_conversation_of_a_third_of_all_rows(spark, settings):
    """Its texts are dealt out by message; only the final row and numbers without texts meet by conversation."""
    settings("spark.sql.shuffle.partitions", "16")
    settings("spark.sql.adaptive.enabled", "false")
    texts = [(-1 if n % 3 == 0 else n, n, "user" if n % 2 else "assistant", f"text {n}") for n in range(3000)]
    turns = spark.createDataFrame(texts, "conv_id long, turn long, role string, text string")
    folded = fold(logged(numbered(turns)))
    sizes = folded.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 3000 and max(sizes) < 400
    back = {r.conv_id: r for r in read_back(render(folded)).collect()}
    assert [t.text for t in back[-1].turns] == [f"text {n}" for n in range(0, 3000, 3)]


def test_the_log_is_folded_by_resets_and_discards(spark, sf_dir):
    plan = op4_chat(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "reset" in plan and "discard" in plan and "regenerate" in plan and "edit" in plan


def test_only_dataframe_functions(spark, sf_dir):
    plan = op4_chat(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
