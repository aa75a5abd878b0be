"""Chat examples against a plain version, and their round trip."""

import hashlib
import re

from llm_helpers import ordered

from basketlens.llm import chat_format
from basketlens.llm.queries import op13_chat_format

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, piece string, at int, replies int"
MARKS = ("[INST]", "[/INST]", "</s>")


def odd_turns(spark):
    texts = ["", None, "\\", "\\\\", "[INST]", "[\\INST]", "</s>\n", "a</s", "<", "[", "[/INST] [INST] x</s></s>", "é\U0001f600\\[INST]", " ", "\n", "x" * 20000]
    roles = ["user", "assistant", "system", None, "", "[/INST]", "assistant ", "</s>\n"]
    rows = [(c, t, roles[(c + t) % len(roles)], texts[(3 * c + 5 * t) % len(texts)]) for c in range(12) for t in range(c)]
    rows += [(20, 0, "assistant", "b"), (20, 0, "assistant", "a"), (20, 0, "user", "a"), (20, None, "assistant", "n"), (20, 0, "assistant", "a")]
    rows += [(None, 1, "assistant", "of no conversation"), (None, 0, "user", None), (21, 0, "user", "alone"), (22, 0, "assistant", "")]
    rows += [(23, t, "assistant" if t % 2 else "user", f"turn {t} \\ </s>") for t in range(600)]
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], TURNS)


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(t)] for c, t in out.items()}


def plain_escape(text):
    text = text.replace("\\", "\\\\")
    for mark in MARKS:
        text = text.replace(mark, mark[0] + "\\" + mark[1:])
    return text


def plain_examples(turns):
    """(text, start of the loss mask, its length) of every example."""
    out, text = [], ""
    for role, body in turns:
        text += f"[INST] {plain_escape(role)} [/INST] "
        start = len(text)
        text += plain_escape(body)
        end = len(text)
        text += "</s>\n"
        if role == "assistant":
            out.append((text, start, end - start))
    if turns and turns[-1][0] != "assistant":
        out.append((text, len(text), 0))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(conversations):
    for conv_id, turns in conversations.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        chars = sum(len(text) for text, _, _ in plain_examples(turns))
        yield conv_id, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), chars


def test_examples_of_odd_turns(spark):
    frame = odd_turns(spark)
    wanted = [(c, i, *e) for c, turns in grouped(frame.collect()).items() for i, e in enumerate(plain_examples(turns))]
    assert ordered(chat_format.examples(frame).collect()) == ordered(wanted)


def test_digests_of_odd_turns(spark):
    frame = odd_turns(spark)
    got = chat_format.digest(chat_format.conversation_texts(frame))
    assert ordered(got.collect()) == ordered(digests(grouped(frame.collect())))
    none = chat_format.digest(chat_format.conversation_texts(frame.where("false")))
    assert none.count() == 0 and none.columns == got.columns


def test_query_and_control_strings(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    wanted = grouped(rows) | {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    assert ordered(op13_chat_format(spark, SF).collect()) == ordered(digests(wanted))
    texts = chat_format.conversation_texts(odd_turns(spark)).collect()
    for row in texts:  # marks of turns are all the control strings there are
        found = re.findall(r"\[INST\]|\[/INST\]|</s>", row.formatted)
        assert found == list(MARKS) * (len(found) // 3)


def test_plan_has_no_python_and_one_exchange(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    plan = chat_format.digest(chat_format.conversation_texts(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") == 1
