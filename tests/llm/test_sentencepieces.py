"""Piece encoding against the library: ids, source bytes, decoding, character maps."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tillwright.llm import sentencepieces as pieces

LETTERS = "aAbeu é▁ß😀\x00\n\t  中文　\xa0<s></s><0x41>ing the"
FIXED = ["", " ", "  ", "a", " a", "a ", "▁", "▁a", " ▁ a  b", "<s>", "hello world\n",
         "x" * 100 + " " + "aeiou" * 40, "é" * 60, "😀" * 70 + " a", "�", "the thing " * 500]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def some_texts(n=1500):
    rng = random.Random(1)
    return FIXED + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def of_library(library, text):
    """(id, begin, end) of the pieces, from the library's own message."""
    found = [dict(pieces._fields(v)) for n, v in
             pieces._fields(library.encode(text, out_type="serialized_proto")) if n == 2]
    return [(f.get(2, 0), f.get(4, 0), f.get(5, 0)) for f in found]


def test_ids_spans_and_text(library):
    texts = some_texts()
    encoder = pieces.Encoder(pieces.parse(pieces.read_model()))
    got = encoder.encode(pa.array(texts))
    decoded = encoder.decode(got.ids, got.bounds)
    for k, text in enumerate(texts):
        own = slice(got.bounds[k], got.bounds[k + 1])
        spans = list(zip(got.ids[own].tolist(), got.begins[own].tolist(), got.ends[own].tolist()))
        assert spans == of_library(library, text), text
        assert decoded[k] == library.decode(library.encode(text))


def test_one_by_one_is_the_same():
    texts = some_texts(200)
    encoder = pieces.Encoder(pieces.parse(pieces.read_model()))
    whole = encoder.encode(pa.array(texts))
    alone = [pieces.Encoder(encoder.model).encode(pa.array([t])) for t in texts[::40]]
    for k, one in zip(range(0, len(texts), 40), alone):
        assert one.ids.tolist() == whole.ids[whole.bounds[k]:whole.bounds[k + 1]].tolist()


def double_array(entries):
    """A double array of {key: value}, laid out by trying offsets in turn."""
    units, taken = {0: 0}, {0}

    def place(at, keys):
        steps = sorted({k[0] for k in keys if k})
        leaf = keys.get(b"")
        wanted = ([0] if leaf is not None else []) + steps
        offset = 1
        while any((at ^ offset ^ s) in taken for s in wanted) or (offset & 0xFF and offset > 0x1FFFFF):
            offset += 1
        units[at] = (units.get(at, 0) & ~(0x3FFFFF << 10)) | (offset << 10)
        for s in wanted:
            taken.add(at ^ offset ^ s)
        if leaf is not None:
            units[at] |= 1 << 8
            units[at ^ offset] = leaf | (1 << 31)
        for s in steps:
            units[at ^ offset ^ s] = s
            place(at ^ offset ^ s, {k[1:]: v for k, v in keys.items() if k and k[0] == s})

    place(0, entries)
    size = (max(units) // 256 + 1) * 256
    return np.array([units.get(i, 0) for i in range(size)], np.uint32)


def mapped_model(entries, squeeze):
    """A small model with a character map; its pieces are what the map can write."""
    strings, values = b"", {}
    for key, to in entries.items():
        values[key.encode()] = len(strings)
        strings += to.encode() + b"\0"
    trie = double_array(values).tobytes()
    names = ["<unk>", "▁", "a", "b", "f", "i", "fi", "▁a", "ab", "1", "x"]
    scores = [0.0, -9, -10, -11, -12, -13, -1, -2, -2, -14, -15]
    return pieces.Model(names, scores, [2] + [1] * 10, charsmap=struct.pack("<I", len(trie)) + trie + strings,
                        squeeze=squeeze)


def plain_normal(entries, squeeze, text):
    """[(character, source offset)], and the end of the last piece, character by character."""
    out, at = [], 0
    raw = text.encode()
    while at < len(raw):
        rest = raw[at:].decode()
        key = max((k for k in entries if rest.startswith(k)), key=lambda k: len(k.encode()), default=None)
        to, size = (entries[key], len(key.encode())) if key else (rest[0], len(rest[0].encode()))
        for c in to:
            if not (squeeze and c == " " and (not out or out[-1][0] == " ")):
                out.append((c, at))
        at += size
    end = len(raw)
    if squeeze and out and out[-1][0] == " ":
        end = out.pop()[1]
    if out:
        out.insert(0, (" ", out[0][1]))
    return [("▁" if c == " " else c, at) for c, at in out], end


@pytest.mark.parametrize("squeeze", [False, True])
def test_character_map(squeeze):
    entries = {"ﬁ": "fi", "A": "a", "AB": "x", "é": "", "\t": " ", "①": "1", "ab́": "ab", "…": "a b"}
    model = mapped_model(entries, squeeze)
    rng = random.Random(4)
    texts = ["", " ", "é", " A AB ﬁ ①\t ", "ab́A…"]
    texts += ["".join(rng.choice(["ﬁ", "A", "AB", "B", "é", "\t", " ", "①", "ab́", "ab", "…", "q"])
                      for _ in range(rng.randint(0, 12))) for _ in range(400)]
    normal = pieces.normalise(model, pa.array(texts))
    encoder = pieces.Encoder(model)
    found = encoder.encode(pa.array(texts))
    for k, text in enumerate(texts):
        want, end = plain_normal(entries, squeeze, text)
        a, b = normal.bounds[k], normal.bounds[k + 1]
        assert normal.data[a:b].tobytes().decode() == "".join(c for c, _ in want)
        assert normal.source[a:b].tolist() == [at for c, at in want for _ in c.encode()]
        own = slice(found.bounds[k], found.bounds[k + 1])
        begins, ends = found.begins[own].tolist(), found.ends[own].tolist()
        assert ends[:-1] == begins[1:] and (not ends or ends[-1] == end)
        known = found.ids[own] != 0
        if known.all() and want:
            assert "".join(model.names[i] for i in found.ids[own]) == "".join(c for c, _ in want)
    assert found.ids.tolist().count(6) > 0


def test_against_the_library_with_a_map(library):
    """The library's own compiled maps, where it offers them."""
    for rule in ("nmt_nfkc", "nfkc_cf"):
        try:
            of = sentencepiece.SentencePieceNormalizer(rule_name=rule, escape_whitespaces=True,
                                                       add_dummy_prefix=True, remove_extra_whitespaces=True)
            proto = of.serialized_model_proto()
        except (AttributeError, RuntimeError, TypeError) as problem:
            pytest.skip(str(problem))
        spec = dict(pieces._fields(dict(pieces._fields(proto))[3]))
        model = pieces.Model(["<unk>", "▁"], [0.0, 0.0], [2, 1], charsmap=spec[2])
        rng = random.Random(3)
        letters = "aAﬁ①½é 　 ​\t\nｶﾞ한ÅⅣ…Ｆ"
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(500)]
        normal = pieces.normalise(model, pa.array(texts))
        for k, text in enumerate(texts):
            got = normal.data[normal.bounds[k]:normal.bounds[k + 1]].tobytes().decode()
            assert got == of.normalize(text), text


def test_refused_models():
    data = pieces.read_model()
    piece = b"\x0a\x04\x0a\x02zz" + b""
    assert pieces.parse(data + piece).names[-1] == "zz"
    with pytest.raises(ValueError):
        pieces.parse(data + b"\x0a\x06\x0a\x02zz\x18\x04")   # set by the user
    with pytest.raises(ValueError):
        pieces.parse(data + b"\x12\x02\x18\x01")             # a unigram model


def test_table(spark, library):
    rows = [(1, "a b", "x", 5), (1, "a b", "x", 5), (None, None, None, 1), (2, "", "y", None),
            (3, "long " * 30_000, None, 0), (4, "é" * 5000, "z", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, begins int")
    got = pieces.encode(df)
    assert got.columns == ["doc_id", "text", "ids", "begins", "ends"]
    back = pieces.decode(got.withColumn("Decoded", F.lit(1))).collect()
    assert len(back) == len(rows)
    for row in back:
        text = row["text"] or ""
        assert row["ids"] == library.encode(text)
        assert row["decoded"] == library.decode(row["ids"]) == text
    assert pieces.encode(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(None,), ([],), ([1, 2, 13],), ([13, 13],)], "ids array<int>")
    assert {str(r["ids"]): r["decoded"] for r in pieces.decode(empty).collect()} == {
        str(i): library.decode(i or []) for i in (None, [], [1, 2, 13], [13, 13])}
