import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import chat

ODD = st.text(alphabet=st.sampled_from(list("<|>s/[]INST\\n\nabé😀")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ODD, ODD)
def test_turns_read_back(role, text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert not any(c in chat.escaped(text) for c in chat.CONTROL)
    found = chat._SEGMENT.fullmatch(chat.rendered(role, text))
    assert (chat.unescaped_role(found[1]), chat.unescaped(found[2])) == (role, text)


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"id": 5, "system": "s", "messages": [{"role": "user", "content": None}]}, [("system", "s"), ("user", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"prompt": "q", "response": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "completion": "a", "system": "s"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"question": "q", "answer": "a", "context": "c"}, [("user", "c\n\nq"), ("assistant", "a")]),
    ({"data": {"prompt": "q", "response": "a"}}, [("user", "q"), ("assistant", "a")]),
    ({"conv_id": 9, "turn": 2, "role": "tool", "text": "t"}, [("tool", "t")]),
]


def test_layouts_are_told_apart(spark):
    records = [(k, json.dumps(r)) for k, (r, _) in enumerate(LAYOUTS)] + [(70, '{"other": 1}'), (71, "no json"), (72, None), (73, "[1]")]
    got = chat.canonical_turns(spark.createDataFrame(records, "conv_id long, record string")).collect()
    for k, (_, wanted) in enumerate(LAYOUTS):
        mine = [r for r in got if r.conv_id == (9 if "conv_id" in LAYOUTS[k][0] else k) and r.role is not None]
        mine = [r for r in mine if r.role == "tool"] if "conv_id" in LAYOUTS[k][0] else [r for r in mine if r.role != "tool"]
        assert [(r.role, r.text) for r in sorted(mine, key=lambda r: r.sub)] == wanted, LAYOUTS[k]
    assert sorted(r.conv_id for r in got if r.role is None) == [70, 71, 72, 73]
    assert chat.fingerprint({"a", "b"}) == chat.fingerprint(["b", "a"]) != chat.fingerprint({"a.b"})


def test_digests_of_rows(spark):
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "a\\b <|end|>\n"), (1, 1, "assistant", "again"),
        (1, 2, "user", None), (2, None, "assistant", ""), (None, 0, "user", "x"), (3, 0, "odd\nrole\\", "t"), (3, 1, "assistant", "é😀" * 3000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.canonical_turns(chat.row_records(table)))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2], r[3] or ""))
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        whole = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in turns)
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[conv].formatted_chars == sum(len(chat.rendered(r[2], r[3] or "")) for r in turns)
    assert chat.digests(chat.formatted(chat.canonical_turns(chat.row_records(table.limit(0))))).count() == 0
