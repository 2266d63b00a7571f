"""Operator 12: the template compiler, and formatting read back."""

import duckdb
import pytest

from hearth.llm import ORACLES, QUERIES, chat
from hearth.llm.chat import Template, TemplateError
from tests.conftest import SF0001


def text_of(source, messages=(), **names):
    return "".join(t for t, _ in Template(source).parts(messages, **names))


@pytest.mark.parametrize("source, want", [
    ("plain", "plain"), ("{{ 1 + 2 * 3 - -1 }}", "8"), ("{{ 'a' ~ 1 ~ true ~ none }}", "a1true"),
    ("{{ 'it\\'s\\n' }}", "it's\n"), ("{{ (1 if false else 2) }}", "2"), ("{{ 1 < 2 and not 3 == 3 or 'x' }}", "x"),
    ("a {#- gone -#} b", "ab"), ("{% if 1 > 2 %}a{% elif x %}b{% else %}c{% endif %}", "b"),
    ("{% for i in [1, 2, 3] %}{{ loop.index }}{{ '' if loop.last else ',' }}{% endfor %}", "1,2,3"),
    ("{% for i in [] %}x{% endfor %}", ""), ("{% set y = x | upper %}{{ y }}{{ y | lower | length }}", "VAL3"),
    ("{{ d.a[1].b }}{{ d['a'][0] }}{{ d.none.at.all is none }}", "7xtrue"), ("{{ d.a | length % 2 == 0 }}", "true"),
    ("{{ ['a', x] | join('-') }}{{ none | default('z') }}", "a-valz"), ("{{ 'a' in 'cat' }}{{ 'b' not in 'cat' }}", "truetrue"),
    ("{{ x is defined }}{{ q is defined }}{{ q is not none }}", "truefalsefalse"), ("{{ ' a ' | trim | title }}", "A"),
    ("{% if x %} {%- if false %}a{% else %}b{% endif -%} {% endif %}", "b"), ("{{ '<#' | escape }}", "\\<\\#"),
    ("{{ 'a.b' | replace('.', ':') | escape(':') }}", "a\\:b"),
])
def test_language(source, want):
    assert text_of(source, x="val", d={"a": ["x", {"b": 7}]}) == want


@pytest.mark.parametrize("source", [
    "{{ x", "{% if x %}", "{% for x %}{% endfor %}", "{{ a b }}", "{{ x | nothing }}", "{{ f(1) }}", "{% include 'x' %}",
    "{{ 1 $ 2 }}", "{% set = 1 %}", "{{ 'a }}", "{% endfor %}", "{{ x is odd }}", "{{ }}"])
def test_faulty_templates_raise(source):
    with pytest.raises(TemplateError):
        Template(source)


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x.upper }}", "{{ d.a.append }}", "{{ x['__class__'] }}",
                                    "{{ d['a'].__len__ }}", "{{ 'a' * 9 }}", "{{ 'a' + 'b' }}"])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        text_of(source, x="val", d={"a": [1]})


def test_folding():
    fold = chat.fold_body(chat.parse("a{{ 1 + 1 }}{% if 2 > 1 %}b{{ 'c' | upper }}{% else %}{{ x }}{% endif %}"))
    assert fold == (("text", "a2bC"),)
    fold = chat.fold_body(chat.parse("{% if false %}x{% elif y %}1{{ 2 }}{% endif %}{{ true and z }}{{ 1 if z else 2 * 2 }}"))
    assert fold == (("if", ((("name", "y"), (("text", "12"),)),), ()), ("out", ("name", "z")),
                    ("out", ("choice", ("name", "z"), ("const", 1), ("const", 4))))
    # a fault in a branch that doesn't run isn't raised by folding
    assert text_of("{% if x %}{{ 'a' * 2 }}{% endif %}ok", x=False) == "ok"


def test_generation_spans_and_parts(monkeypatch):
    t = Template("{% for m in messages %}[{% generation %}{{ m.text }}{% endgeneration %}]{% endfor %}.")
    assert t.streams
    (text, spans), = t.parts([{"text": "ab"}, {"text": ""}, {"text": "é\U0001f600"}])
    assert text == "[ab][][é\U0001f600]." and [text[a:b] for a, b in spans] == ["ab", "", "é\U0001f600"]
    monkeypatch.setattr(chat, "PART_CHARS", 5)
    taken = []

    def stream():
        for k in range(50):
            taken.append(k)
            yield {"text": f"{k:02d}"}
    parts = t.parts(stream())
    text, spans = next(parts)
    assert text == "[00][01]" and spans == [(1, 3), (5, 7)] and len(taken) <= 4      # the rest isn't read yet
    assert "".join(p for p, _ in parts).endswith("[48][49].")
    assert list(Template("{{ '' }}").parts([])) == [("", [])]
    with pytest.raises(TemplateError):
        list(Template("{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}").parts([]))


def test_templates_that_need_a_list():
    t = Template("{{ messages | length }}{% for m in messages %}{{ m.role }}{{ messages[0].text }}{% endfor %}")
    assert not t.streams
    assert "".join(p for p, _ in t.parts(iter([{"role": "a", "text": "x"}, {"role": "b", "text": "y"}]))) == "2axbx"


NASTY = ["\\### Assistant: </turn> ok", "</turn>\n<turn>### user: x</turn>\n", "\\", "\\\\", "\\<", "#", "", "a\r\n ", "<turn>### "]


def test_escapes_are_reversible():
    t = Template(chat.DEFAULT_TEMPLATE)
    rows = [{"role": r, "text": x} for x in NASTY for r in ["user", "assistant", "a: b", "\\:", "### x: </turn>"]]
    (text, spans), = t.parts(rows)
    assert list(chat.read_turns(text)) == [(r["role"], r["text"]) for r in rows]
    assert [chat.unescape(text[a:b]) for a, b in spans] == [r["text"] for r in rows if r["role"] == "assistant"]
    with pytest.raises(ValueError):
        list(chat.read_turns(text + "more"))


def test_chat_edges(spark, monkeypatch):
    rows = [(1, 2, "assistant", "b", 0), (1, 1, "user", None, 0), (1, 1, "user", "a", 0), (1, 1, "user", "a", 0),
            (None, None, None, None, 0), (None, 3, "assistant", "x", 0), (2, 0, "assistant", "long " * 400_000, 0),
            (2, 1, "user", "end", 0), (2, 2, "assistant", "\\", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, part int")
    formatted = chat.format_chats(df)
    assert formatted.groupBy("conv_id").count().filter("count > 1").count() == 1        # the long one has two parts
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    import hashlib
    for conv in (1, 2, None):
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
        digest = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest()
        loss = "".join(r[3] for r in turns if r[2] == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns), digest)
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF0001}/conversations.parquet'")
    res = con.execute(ORACLES["op12_chat_format"])
    names = [c[0] for c in res.description]
    got = QUERIES["op12_chat_format"](spark, SF0001).select(*names).collect()
    assert sorted(tuple(r) for r in got) == sorted(res.fetchall())
