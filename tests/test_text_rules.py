"""Table-driven tests of the text rules; expectations derived by reading the
reference's rules (SURVEY §2.9 traps)."""

from support import one_col

from tessera.functions import text as T

NBSP, FS = "\u00a0", "\x1c"


def test_py_strip_unicode_whitespace(spark):
    vals = [f"{NBSP} a b {FS}", "\t\nx\u3000", "", "  ", None]
    assert one_col(spark, vals, T.py_strip) == ["a b", "x", "", "", None]


def test_validate_lengths_and_letters(spark):
    vals = ["ab", "abc", "a" * 200, "a" * 201, "123", f"{NBSP}ab{NBSP}", "a" * 75 + " " * 60 + "a" * 75, None, "  abc  "]
    got = one_col(spark, vals, T.validate_text)
    # length is taken after strip but before whitespace collapse
    assert got == [False, True, True, False, False, False, False, False, True]


def test_clean_text(spark):
    vals = ["  hello   world ", "'abc\"", "\" word\"", "'quoted'", "éclair", "ß start", "x"]
    got = one_col(spark, vals, T.clean_text)
    # mismatched quotes are dropped; a leading space left by the quote strip blocks capitalisation
    assert got == ["Hello world", "Abc", " word", "Quoted", "Éclair", "SS start", "X"]


def test_dedup_key(spark):
    assert one_col(spark, ["  Hello World\t"], T.dedup_key) == ["hello world"]


def test_slugify(spark):
    vals = ["Hello, World!", "--a__b--", "3-tier pricing table", "split image+text hero"]
    assert one_col(spark, vals, T.slugify) == ["hello-world", "a-b", "3-tier-pricing-table", "split-image-text-hero"]


def test_strip_code_fences(spark):
    vals = ['```json\n["a"]\n```', '  ```\n[1]\n```  ', '["x"]', '```json\n["a"]', 'pre ```json\n[1]\n```']
    assert one_col(spark, vals, T.strip_code_fences) == ['["a"]', "[1]", '["x"]', '["a"]', 'pre ```json\n[1]\n```']


def test_placeholders_and_blocks(spark):
    html = "{{a}} {{ spaced }} {{é}} {{a}} <!--REPEAT:items--> <!--  REPEAT:g2 \n--> <!-- REPEAT: bad -->"
    ph = one_col(spark, [html], lambda c: T.placeholders(c))[0]
    assert sorted(ph) == ["a", "é"]
    bl = one_col(spark, [html], lambda c: T.repeat_blocks(c))[0]
    assert sorted(bl) == ["g2", "items"]


def test_code_blocks(spark):
    text = "Intro\n```python\nprint(1)\n```\nmid\n```\n  x = 2  \n```\nend ```sh\nunclosed"
    blocks = one_col(spark, [text], T.code_blocks)[0]
    assert [(b["language"], b["code"]) for b in blocks] == [("python", "print(1)"), ("text", "x = 2")]
    expl = one_col(spark, [text], T.code_explanation)[0]
    assert expl == "Intro\n\nmid\n\nend ```sh\nunclosed"


def test_split_reasoning(spark):
    vals = ["pre <think> r1 </think> ans ", "<think>open reasoning", "plain answer ", "<think></think>"]
    got = one_col(spark, vals, T.split_reasoning)
    assert [(g["reasoning"], g["answer"]) for g in got] == [
        ("r1", "ans"),
        ("open reasoning", ""),
        ("", "plain answer"),
        ("", ""),
    ]


def test_previews(spark):
    s = "x" * 205
    assert one_col(spark, [s, "short"], T.head_preview) == ["x" * 200 + "...", "short"]
    assert one_col(spark, [s, "short"], T.tail_preview) == ["..." + "x" * 200, None]


def test_quote_strips(spark):
    vals = ['"ls -la"', "'ls'", "\"mixed'", '"', "''", ' "a" ', "'\"q\"'"]
    assert one_col(spark, vals, T.strip_paired_quotes) == ["ls -la", "ls", "\"mixed'", '"', "", ' "a" ', '"q"']
    assert one_col(spark, vals, T.strip_quote_chars) == ["ls -la", "ls", "mixed", "", "", ' "a" ', "q"]


def test_length_counts_code_points(spark):
    # 😀 is one code point (two UTF-16 units): "😀éa" has length 3 and is valid, "😀é" is too short
    assert one_col(spark, ["😀éa", "😀é"], T.validate_text) == [True, False]
    assert one_col(spark, ["😀" * 201, "x" + "😀" * 199], lambda c: T.validate_text(c)) == [False, True]


def test_capitalise_only_lowercase_first(spark):
    # U+01C5 is titlecase (islower() is False), so it stays; digits and capitals stay too
    assert one_col(spark, ["ǅungla", "9 lives", "Already", "über"], T.clean_text) == ["ǅungla", "9 lives", "Already", "Über"]
