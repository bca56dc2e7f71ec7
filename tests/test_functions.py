import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.functions import docs, keys, text, vectors
from chunkloom.operators.chunking import content_id, file_chunks, sliding_windows
from chunkloom.operators.symbols import symbols


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_normalize_text_knows_every_unicode_space(spark):
    s = "\u00a0a\u001cb\u0085c\u3000d\r\n e "
    assert one(spark, text.normalize_text(F.lit(s))) == " ".join(s.split())
    assert one(spark, text.normalize_text(F.lit(None).cast("string"))) is None
    assert one(spark, text.normalize_text(F.lit(""))) == ""


def test_first_truthy_takes_empty_for_absent(spark):
    assert one(spark, text.first_truthy(F.lit(""), F.lit(None).cast("string"), F.lit("b"))) == "b"
    assert one(spark, text.first_truthy(F.lit(None).cast("string"))) == ""


def test_clean_doc(spark):
    assert one(spark, text.clean_doc(F.lit(" * First one.\n * Second. "))) == "First one." == docs.clean(" * First one.\n * Second. ")
    assert one(spark, text.clean_doc(F.lit("no end"))) == "no end"


def test_assign_query_precedence(spark):
    none = F.lit(None).cast("string")
    q = lambda *a: tuple(one(spark, text.assign_query(*[F.lit(x) if x is not None else none for x in a])))
    assert q("A b.", "c", "d") == ("A b.", "codesearchnet")
    assert q("  ", "c", "d") == ("c", "docstring")
    assert q(None, "", "d") == ("d", "commit")
    assert q(None, None, None) == ("", "none")
    kept = text.keep_existing_query(F.lit(" * raw"), text.assign_query(none, F.lit("c"), none))
    assert tuple(one(spark, kept)) == (" * raw", "codesearchnet")


@pytest.mark.parametrize(("n", "want"), [(0, None), (15, None), (16, None), (40, 13), (1024, 341), (1026, 1000)])
def test_token_bounds(spark, n, want):
    got = one(spark, text.bounded_tokens(F.lit("x" * n), F.lit(1000 if n > 1024 else 3), 8, 512))
    assert got == want


def test_keys(spark):
    want = hashlib.blake2b(b"a b\0r\0p\x001\x002", digest_size=16).hexdigest()
    args = [F.lit(" a\n b"), F.lit("r"), F.lit("p"), F.lit(1), F.lit(2)]
    assert one(spark, keys.chunk_id(*args)) == want == content_id(" a\n b", "r", "p", 1, 2)
    assert one(spark, keys.chunk_id(*args, hash_fn="md5")) == hashlib.md5(b"a b\0r\0p\x001\x002").hexdigest()
    with pytest.raises(ValueError):
        keys.chunk_id(*args, hash_fn="crc")
    top = "ffffffffffffffff" + "0" * 16
    assert one(spark, keys.chunk_int64(F.lit(top))) == 2**63 - 1 == one(spark, keys.int64_of_hex(F.lit(top)))
    other = int(hashlib.blake2b(b"zz", digest_size=8).hexdigest(), 16) & (2**63 - 1)
    assert one(spark, keys.chunk_int64(F.lit("zz"))) == other
    assert one(spark, keys.int64_of_hex(F.lit("zz"))) is None
    assert one(spark, keys.bucket(F.lit("o/r"), 42)) == int(hashlib.blake2b(b"42:o/r", digest_size=8).hexdigest(), 16) % 1000


@pytest.mark.parametrize(("slot", "listed", "empty", "want"), [(0, True, False, "eval_test"), (49, False, False, "eval_valid"), (50, False, True, "eval_test"), (50, False, False, "index_only"), (100, False, True, "index_only")])
def test_eval_split(spark, slot, listed, empty, want):
    assert one(spark, keys.eval_split(F.lit(slot), F.lit(listed), F.lit(empty))) == want


def test_vectors(spark):
    v = F.array(*[F.lit(float(x)) for x in (3, 4, 12)])
    assert one(spark, vectors.truncate_and_normalize(v, 2)) == pytest.approx([0.6, 0.8])
    assert one(spark, vectors.truncate_and_normalize(v, 3)) == [3, 4, 12]
    zero = F.array(F.lit(0.0), F.lit(0.0))
    assert one(spark, vectors.l2_normalize(zero)) == [0, 0]
    assert one(spark, vectors.metric("l2", v, v)) == 0
    with pytest.raises(ValueError):
        vectors.metric("cosines", v, v)


@given(st.integers(0, 300), st.integers(1, 40), st.integers(-5, 60))
@settings(max_examples=200, deadline=None)
def test_windows_cover_everything(n, window, overlap):
    got = sliding_windows(n, window, overlap)
    assert [i for i in range(n) if not any(a <= i < b for a, b in got)] == []
    assert (not got) == (n == 0)
    assert all(b - a == window for a, b in got[:-1])
    if got:
        assert got[-1][1] == n
        assert all(b < n for _, b in got[:-1])


def test_windows_reject_no_window():
    with pytest.raises(ValueError):
        sliding_windows(3, 0, 1)


def test_window_starts_agree(spark):
    for n in (0, 1, 5, 8, 9, 33):
        got = one(spark, text.window_starts(F.lit(n), 8, 3))
        assert got == [a for a, _ in sliding_windows(n, 8, 3)]


@pytest.mark.parametrize(
    ("source", "language", "want"),
    [
        ('def f(a):\n    """Doc."""\n    return a\n', "python", "def f(a):\n\n    return a\n"),
        ('async def f(a):\n    r"""Doc."""\n    pass', "python", "async def f(a):\n\n    pass"),
        ('def f(a):\n    """open', "python", 'def f(a):\n    """open'),
        ('"""Module."""\nx = 1', "python", "\nx = 1"),
        ("def f(\n  a):\n    '''D'''\n", "python", "def f(\n  a):\n    '''D'''\n"),
        ("/** D */\nint f() {}", "java", "int f() {}"),
        ("/* D */ int f() {}", "go", "int f() {}"),
        ("// a\n\n// b\ncode", "javascript", "code"),
        ("# a\ncode", "ruby", "code"),
        ("code // a", "php", "code // a"),
        ("# a", "rust", "# a"),
        ("", "python", ""),
        (None, "python", None),
    ],
)
def test_strip_leading(source, language, want):
    assert docs.strip_leading(source, language) == want


@pytest.mark.parametrize(
    ("source", "language", "want"),
    [
        ('def f(\n  a,\n):\n    """Does it. More."""\n', "python", "Does it."),
        ("class A:\n    def f(self):\n        '''Inner one.'''", "python", "Inner one."),
        ("/**\n * Adds. Twice.\n * @param a x\n */\nint f()", "java", "Adds."),
        ("/** Block. */\nx", "python", "Block."),
        ("// no", "go", ""),
        (None, "go", ""),
    ],
)
def test_extract(source, language, want):
    assert docs.extract(source, language) == want


def test_symbols_of_six_languages():
    py = "class A:\n    def m(self):\n        def inner():\n            pass\n\nasync def g():\n    pass\n"
    assert [(s.kind, s.name, s.line) for s in symbols(py, "python")] == [("class", "A", 1), ("function", "m", 2), ("function", "g", 6)]
    java = "public class A {\n  int f(int a) {\n    if (a > 0) { return 1; }\n    return 0;\n  }\n}\n"
    assert [(s.kind, s.name) for s in symbols(java, "java")] == [("class", "A"), ("method", "f")]
    js = "class A {\n  m(x) {\n    return '}';\n  }\n}\nfunction g() {\n}\n"
    assert [(s.kind, s.name) for s in symbols(js, "javascript")] == [("class", "A"), ("method", "m"), ("function", "g")]
    assert [(s.kind, s.name) for s in symbols("func (t *T) M(a int) error {\n}\nfunc F() {\n}\n", "go")] == [("method", "M"), ("function", "F")]
    assert [(s.kind, s.name) for s in symbols("class A\n  def m\n    1\n  end\nend\n", "ruby")] == [("class", "A"), ("method", "m")]
    assert [(s.kind, s.name) for s in symbols("<?php\nclass A {\n  public function m($a) {\n  }\n}\nfunction g() {\n}\n", "php")] == [("class", "A"), ("method", "m"), ("function", "g")]
    assert symbols("def (", "python") == [] == symbols("x", "cobol")


def test_file_chunks_edges():
    assert list(file_chunks("", "python")) == []
    assert list(file_chunks("def f():\n    1\n", "python", least=50)) == []  # symbols, all too small
    (only,) = file_chunks("print(1, 2, 3, 4, 5)\n", "python", exact=True)
    assert only[0] == "whole_file" and only[4] == 12
    pieces = list(file_chunks("a " * 100, "text", limit=30, overlap=5, least=2))
    assert {p[0] for p in pieces} == {"window"} and all(p[5] for p in pieces)
    assert pieces[0][7] == pieces[0][2]  # the key is made with the first line
