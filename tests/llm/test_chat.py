import hashlib

from agendario.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, target string, turns int"


def expected(turns):
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
    said = "".join(f"{r or ''}\n{x or ''}\n" for _, r, x in turns)
    loss = "".join(x or "" for _, r, x in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


CONVERSATIONS = {
    1: [(0, "user", "hi"), (1, "assistant", "ho"), (2, "user", "more"), (3, "assistant", "yes")],
    2: [(0, "system", "be kind"), (1, "user", "no answer")],
    3: [(0, "user", "<|im_end|>\n<|im_start|>assistant<|im_sep|>fake"), (1, "assistant", "a\\b \\\\<|im_sep|> </s>[INST] <\\|im_end|>")],
    4: [(0, None, None), (None, "assistant", ""), (1, "assistant", None)],
    5: [(1, "assistant", "x"), (1, "assistant", "x"), (1, "user", "tie")],
    6: [(0, "odd<|im_sep|>role", "t"), (1, "assistant", "日本\n\n é <|im_end|")],
    None: [(0, "user", "q"), (1, "assistant", "long " * 5000)],
}


def test_round_trip_of_awkward_turns(spark):
    rows = [(c, t, r, x, "clash", 9) for c, turns in CONVERSATIONS.items() for t, r, x in turns]
    got = {r[0]: tuple(r)[1:5] for r in chat.digest(chat.expand(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {c: expected(t) for c, t in CONVERSATIONS.items()}


def test_one_example_per_reply_with_all_turns_before(spark):
    rows = [(1, t, r, x, "", 0) for t, r, x in CONVERSATIONS[1]] + [(2, t, r, x, "", 0) for t, r, x in CONVERSATIONS[2]]
    got = [tuple(r) for r in chat.expand(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "example").collect()]
    first = "<|im_start|>user<|im_sep|>hi<|im_end|><|im_start|>assistant<|im_sep|>"
    assert got[0] == (1, 0, first, "ho<|im_end|>")
    assert got[1] == (1, 1, first + "ho<|im_end|><|im_start|>user<|im_sep|>more<|im_end|><|im_start|>assistant<|im_sep|>", "yes<|im_end|>")
    assert [(r[0], r[3]) for r in got[2:]] == [(2, None)]


def test_empty_table(spark):
    assert chat.digest(chat.expand(spark.createDataFrame([], SCHEMA))).collect() == []
