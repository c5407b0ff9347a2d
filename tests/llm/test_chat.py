"""Perspectives: every participant's sample, its offsets and what is trained on."""

from parcelwise.llm import chat

ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi é😀"), (1, 2, "bob", "Hello"), (1, 3, "eve", None), (1, 4, "ann", ""), (1, 4, "ann", ""),
    (2, 0, "system", "alone"), (3, None, None, "who?"), (3, 2, "ann", "first"), (3, 2, "ann", "other"), (None, 0, "bob", "no id"),
]


def plain(rows):
    said = {(c, t, r or "unknown", x or "") for c, t, r, x in rows}
    out = {}
    for conv in {c for c, *_ in said}:
        turns = sorted((s for s in said if s[0] == conv), key=lambda s: (s[1] is not None, s[1] or 0, s[2], s[3]))
        for me in {s[2] for s in turns} - {"system"}:
            text, trained = "", []
            for _, _, who, body in turns:
                head = "assistant" if who == me else "system" if who == "system" else f"user name={who}"
                text += f"<|im_start|>{head}\n"
                start = len(text)
                text += f"{body}<|im_end|>"
                if who == me:
                    trained.append((start, len(text)))
                text += "\n"
            out[conv, me] = (text, trained)
    return out


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segment string")


def test_samples(spark):
    got = chat.samples(chat.perspectives(frame(spark))).collect()
    assert {(r["conv_id"], r["perspective"]): (r["text"], [tuple(t) for t in r["trained"]]) for r in got} == plain(ROWS)


def test_segments_join_without_gaps(spark):
    rows = [(5, i, f"p{i * 7 % 4}", f"text {i}") for i in range(3000)]
    got = chat.perspectives(frame(spark, rows)).where("perspective = 'p2'").orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(3000))
    assert all(a["end"] == b["start"] for a, b in zip(got, got[1:])) and got[0]["start"] == 0
    assert all(len(r["segment"]) == r["end"] - r["start"] for r in got)
    assert {r["role"] for r in got if r["train_start"] is not None} == {"assistant"}


def test_no_window_holds_a_whole_dialogue(spark):
    """Windows run over blocks of a dialogue, turns of a block, and rows of a turn."""
    plan = chat.perspectives(frame(spark))._jdf.queryExecution().optimizedPlan().toString()
    parts = [line.split("windowspecdefinition(")[1] for line in plan.splitlines() if "windowspecdefinition(" in line]
    last = [p for p in parts if "body#" in p]
    assert parts and last and all("_block#" in p.split("body#")[0] and "turn#" in p.split("body#")[0] for p in last)


def test_empty_table(spark):
    assert chat.perspectives(frame(spark).limit(0)).count() == 0
