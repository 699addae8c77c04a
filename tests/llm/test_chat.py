import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.oracle_check import duck_connection
from tidewire.llm import chat
from tidewire.llm.queries import OP5_READ_BACK, op5_chat_format

FOLDER = "/root/testdata/sf0.01"
TURNS = "conv_id bigint, turn bigint, role string, text string"
T = chat.Template()
PIECES = st.sampled_from([*T.controls, "<", "[", "\\", "|im_end|>", "/INST]", "s>", "\n", "a", "<SYS>>", "n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=8).map("".join))
def test_escaping_is_undone(text):
    hidden = T.escape(text)
    assert T.unescape(hidden) == text and not any(c in hidden for c in T.controls)
    assert list(T.parse(T.turn(text, text)[0] * 2)) == [(text, text)] * 2


def test_read_back_equals_sql(spark):
    got = op5_chat_format(spark, FOLDER).toPandas().sort_values("conv_id").reset_index(drop=True)
    want = duck_connection(FOLDER).execute(OP5_READ_BACK).df().sort_values("conv_id").reset_index(drop=True)
    assert got[list(want.columns)].equals(want)


def conversation(conv, n, system=True, size=40):
    rng = random.Random(conv)
    roles = ["system"] * system + ["user", "assistant"] * n
    return [(conv, i, role, " ".join(f"w{rng.randrange(99)}" for _ in range(size))) for i, role in enumerate(roles)]


def test_windows(spark):
    config = chat.ChatConfig(budget=400, history_turns=2, history_tokens=200)
    rows = conversation(1, 12) + conversation(2, 1, False)
    made = chat.windows(spark.createDataFrame(rows[::-1], TURNS), config).collect()
    texts = {(c, t): x for c, t, _, x in rows}
    one = sorted((w for w in made if w.conv_id == 1), key=lambda w: w.window)
    assert len(one) > 3 and all(w.n_tokens <= 400 and not w.over_budget for w in made)
    at, trained = 0, []
    for w in one:
        turns = list(T.parse(w.formatted))
        assert turns[0][0] == "system" and w.first_turn == at and len(turns) == w.n_context + w.n_turns
        assert [t for _, t in turns[w.n_context :]] == [texts[1, at + k] for k in range(w.n_turns)]
        history = turns[1 : w.n_context]
        assert [t for _, t in history] == [texts[1, at - len(history) + k] for k in range(len(history))]
        assert w.window == 0 or 1 <= len(history) <= 2
        trained += [T.unescape(w.formatted[m.start : m.end]) for m in w.mask]
        at += w.n_turns
    assert trained == [x for _, _, role, x in conversation(1, 12) if role == "assistant"]


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 3, "assistant", "x"),
        (2, 1, "assistant", "y" * 9000), (2, 0, "system", "s"), (2, 2, "odd\nrole\\n", "</s>"), (3, 5, "assistant", ""),
    ]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "'clash' AS formatted", "1 AS window")
    made = chat.windows(frame)
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, None: 1, 2: 3, 3: 1}
    assert (got[2].loss_chars, got[None].loss_chars, got[3].loss_chars, got[1].loss_chars) == (9000, 1, 0, 0)
    big = [w for w in made.collect() if w.over_budget]
    assert len(big) == 1 and big[0].n_turns == 1 and big[0].n_context == 1
    assert chat.digests(chat.windows(spark.createDataFrame([], TURNS))).count() == 0
