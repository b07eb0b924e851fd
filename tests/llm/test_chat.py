import pytest
from test_llm_helpers import random_texts

from formlens.llm import chat as C

NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>\n", "100% %3C %25 %5B", "<<SYS>> <s> </s>", "a\nb\r\n", "", None, "é字", "<|again|>", "x" * 3000]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("span,history", [(20, 10), (256, 64), (5, 0), (1000, 1000)])
def test_round_trip_and_targets_once(spark, span, history):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY + random_texts(1, 20, 30))]
    rows += [(2, 0, "system", "be kind"), *[(2, i + 1, "assistant" if i % 2 else "user", t) for i, t in enumerate(random_texts(2, 15, 30))]]
    rows += [(None, 0, "user", "hi"), (None, 1, None, None), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (3, 0, "user", "b")]
    out = C.windows(frame(spark, rows).repartition(3), span, history)
    read = sorted(C.read_back(out).collect(), key=lambda x: (x.conv_id is None, x.conv_id or 0, x.window))
    for conv in (1, 2, 3, None):
        own = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        windows = [x for x in read if x.conv_id == conv]
        assert [(t.role, t.text) for x in windows for t in x.turns] == [(r, t) for _, r, t in own]
        assert [t for x in windows for t in x.targets] == [t for _, r, t in own if r == "assistant"]
    texts = {(x.conv_id, x.window): x.text for x in out.collect()}
    assert all(t.startswith(("<|turn|>system", "<|again|>system")) for (c, _), t in texts.items() if c == 2)


def test_budget(spark):
    turns = [(1, 0, "system", "s " * 10)] + [(1, i, "user" if i % 2 else "assistant", "w " * 16) for i in range(1, 200)]
    out = C.windows(frame(spark, turns), 100, 50).collect()
    assert len(out) > 30
    # system, history, span, and the rest of the last turn
    assert max(x.text.count("w ") + x.text.count("s ") + 4 * x.text.count("<|text|>") for x in out) <= 14 + 50 + 100 + 20


def test_empty_and_bad_budget(spark):
    assert C.windows(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        C.windows(frame(spark, []), 10, 20)
