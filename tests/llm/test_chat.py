import hashlib
import random

import pytest

from demandspark.llm import chat
from demandspark.llm.templates import Const, Output, TemplateError, compile_template, parse
from tests.llm import samples


def rendered(source, **names):
    return "".join(text for text, _ in compile_template(source)(names))


@pytest.mark.parametrize(
    "source, names, want",
    [
        ("a{{ x }}b", {"x": 3}, "a3b"),
        ("{{ x }}{{ y.z }}{{ y['z'] }}", {"y": {"z": "q"}}, "qq"),
        ("{% if a and not b %}1{% elif b or c == 'k' %}2{% else %}3{% endif %}", {"a": 1, "b": 0}, "1"),
        ("{% if a and not b %}1{% elif b or c == 'k' %}2{% else %}3{% endif %}", {"c": "k"}, "2"),
        ("{% for v in vs %}{{ loop.index }}{{ v }}{% if not loop.last %},{% endif %}{% endfor %}", {"vs": "xyz"}, "1x,2y,3z"),
        ("{% set t = 'a' + 'b' %}{{ t | upper }}{# no #}", {}, "AB"),
        ("{{ 'it\\'s' }}{{ \"\\n\" }}{{ (1 + 2) - 1 }}", {}, "it's\n2"),
        ("{{ none }}{{ missing.key }}", {}, ""),
        ("{{ 1 < 2 and 3 >= 3 }}", {}, "True"),
    ],
)
def test_language(source, names, want):
    assert rendered(source, **names) == want


def test_constants_fold_and_dead_branches_go():
    assert parse("a{{ 'b' + 'c' | upper }}{% if 1 > 2 %}x{% else %}d{% endif %}", {"upper": str.upper}) == [Output(Const("abCd"))]


@pytest.mark.parametrize(
    "source", ["{{ a.__class__() }}", "{% if x %}", "{{ x | evil }}", "{% import os %}", "{{ 1 + }}", "{% endfor %}", "{{ ? }}", "{{ a. }}", "{{ (1 }}"]
)
def test_anything_else_is_refused(source):
    with pytest.raises(TemplateError):
        parse(source, {})


def test_python_attributes_are_out_of_reach():
    assert rendered("{{ x.__class__ }}{{ x['__class__'] }}", x="s") == ""


def test_rendering_is_lazy():
    def endless():
        n = 0
        while True:
            yield n
            n += 1

    pieces = compile_template("{% for n in ns %}{{ n }}{% generation %};{% endgeneration %}{% endfor %}")({"ns": endless()})
    assert [next(pieces) for _ in range(4)] == [("0", False), (";", True), ("1", False), (";", True)]


def test_escapes_are_reversible():
    rng = random.Random(0)
    letters = [*chat.CONTROL, "\\", "\\n", "\n", "n", "<", "[", "|", "s>", "/INST]", "a", "é", "<\\s>", "\\\\"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROL)
        line = chat.escape_line(text)
        assert chat.unescape_line(line) == text and "\n" not in line


def conversations():
    rng = random.Random(3)
    bits = [*chat.CONTROL, " hello ", "\n", "\\", "é", "assistant\n", ""]
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", None, "odd\nrole", "<|im_end|>"])
            rows.append((conv, turn, role, None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))))
    return rows + [(None, 0, "user", "lost"), (40, None, "assistant", "x"), (40, 1, "assistant", "y"), (40, 1, "assistant", "y"), (41, 0, None, None)]


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        size = sum(len(f"<|im_start|>{chat.escape_line(role)}\n{chat.escape(text)}<|im_end|>\n") for _, _, role, text in turns)
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part", [1 << 20, 40])
def test_round_trip_matches_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART_CHARS", part)
    turns = spark.createDataFrame(conversations(), "conv_id bigint, turn bigint, role string, text string")
    turns = turns.selectExpr("*", "'c' as part", "'c' as formatted", "1 as spans").repartition(4)
    assert samples.collected(chat.round_trip(turns)) == brute(conversations())
    if part < 100:
        assert chat.format_conversations(turns).filter("part > 0").count() > 0


def test_empty_table(spark):
    assert chat.round_trip(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0
