"""Language ID, fingerprints, SentencePiece, packing, chat: brute force, round trips and held-out accuracy."""

from __future__ import annotations

import functools
import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import chat, language, packing, piecewise, transducer
from quern.plans.tables import table
from tests.conftest import TESTDATA

SCHEMA = "doc_id bigint, text string, lang string, k string, h int, c int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "k", 1, 2) for i, t, lang in rows], SCHEMA)


ODD = [(1, None, "en"), (2, "", None), (3, "1 ² ³ !", "en"), (4, "x" * 70_000, None), (5, "Wörter und mehr", "de"),
       (5, "Wörter und mehr", "de"), (None, "the word", "en"), (7, "▁ a  b\n", None)]


# ---- language ID


def test_language_held_out_accuracy(spark):
    docs = table(spark, TESTDATA, "documents")
    model = language.train(docs.where(~language.held_out()))
    got = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out())
    right, n = got.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right / n > 0.95


def test_language_table_is_bounded_in_characters(monkeypatch):
    model = language.Model(["a", "b"], {"known": 0}, {"q": 1, "z": 2}, np.array([[0.0, -9.0], [-1.0, -2.0], [-5.0, -3.0]]))
    free, bounded = language.Scorer(model), language.Scorer(model)
    texts = ["q" * 400 + " known " + "zq" * n for n in range(1, 300, 7)] + ["z" * 5000, "known q z"]
    expected = [free.predict(t) for t in texts]
    monkeypatch.setattr(language, "KNOWN_CHARACTERS", 1000)
    for text, want in zip(texts * 2, expected * 2, strict=True):
        assert bounded.predict(text) == want
        unseen = [w for w in bounded.index if w not in model.words]
        assert bounded.characters == sum(map(len, unseen))
        assert sum(map(len, unseen)) <= max(1000, sum(map(len, text.split())))


def test_language_odd_rows(spark):
    model = language.train(documents(spark, [(1, "the word the other", "en"), (2, "das Wort und mehr Wörter", "de"), (3, None, "fr"), (4, "x", None)]))
    assert model.languages == ["de", "en"]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(documents(spark, ODD), model).collect()]
    assert [g[:2] for g in got[:3]] == [(1, "und"), (2, "und"), (3, "und")] and got[0][2] == 0
    assert {g[1] for g in got if g[0] == 5} == {"de"} and all(0 <= g[2] <= 1 for g in got)
    assert [g[1] for g in got if g[0] is None] == ["en"]
    nothing = language.train(documents(spark, []))
    assert {r["lang_pred"] for r in language.identify(documents(spark, ODD), nothing).collect()} == {"und"}
    assert language.identify(documents(spark, []), model).count() == 0
    kept = language.keep_identified(documents(spark, ODD), documents(spark, [(9, "a b", "en")]))
    assert kept.columns == documents(spark, []).columns and kept.count() == 5


def test_rare_languages_keep_their_rows_and_words(spark):
    letters = "abcdefghijklmnopqrst"
    rows = [(i, f"common{letters[i % 20]}{letters[i // 20 % 20]} usual", "big") for i in range(900)]
    rows += [(1000 + i, f"seldom rareword{letters[i]}", "it's `odd`") for i in range(3)] + [(2000, "unique", "one")]
    model = language.train(documents(spark, rows), max_rows=60, max_words=30, max_grams=90)
    assert model.languages == ["big", "it's `odd`", "one"]
    assert {"seldom", "rareworda", "rarewordb", "rarewordc", "unique", "usual"} <= set(model.words)
    assert len(model.words) <= 30 and len(model.grams) <= 90
    asked = [(1, "seldom rarewordb", None), (2, "unique", None), (3, "usual commonab", None)]
    got = language.identify(documents(spark, asked), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["it's `odd`", "one", "big"]


def test_quotas_go_round():
    assert language._quotas({"a": 900, "b": 3, "c": 40}, 60) == {"b": 3, "c": 28, "a": 29}
    assert language._quotas({"a": 5, "b": 3}, 60) == {"a": 5, "b": 3}
    assert language._quotas({}, 60) == {}


def test_texts_with_letters_stay_without_a_model(spark):
    docs = documents(spark, ODD)
    kept = language.keep_identified(docs, documents(spark, [(1, "some text", None)]))
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, t, _ in ODD if t and any(c.isalpha() for c in t))


def test_backoff_goes_to_shorter_grams():
    model = language.Model(["a", "b"], {"known": 0}, {"_ab": 1, "z": 2}, np.array([[0.0, -9.0], [-1.0, -2.0], [-5.0, -3.0]]))
    scorer = language.Scorer(model)
    assert scorer.unseen("abz").tolist() == [(-1 - 5) / 2, (-2 - 3) / 2]  # _ab at its start, then only z
    assert scorer.unseen("qq").tolist() == model.scores.min(axis=0).tolist()
    assert scorer.predict("known known")[0] == "a"


# ---- fingerprints


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t, _ in order]
    for n, (key, _, _) in enumerate(order):
        text, after = texts[n], texts[(n + 1) % len(texts)]
        third = len(text) // 3
        yield key, text, text[: len(text) - third] + after[:third], after


@pytest.mark.parametrize("parts", [1, 3, None])
def test_edited_pairs(spark, parts):
    rows = ODD + [(i, " ".join(f"w{(i * j) % 97}" for j in range(i * 7)), "en") for i in range(20, 60)]
    got = sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"])
                 if r["doc_id"] is not None else (-1, r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"])
                 for r in piecewise.edited_pairs(documents(spark, rows), parts=parts).collect())
    want = sorted((-1 if k is None else k, len(t), hashlib.sha256(e.encode()).hexdigest(), piecewise.fingerprint(t), piecewise.fingerprint(e))
                  for k, t, e, _ in brute_edits(rows))
    assert got == want


def plain_fingerprint(text):
    """Byte by byte with Python's integers: every window and chunk is summed anew."""
    data, word = text.encode(), 1 << 64

    def value(start, stop, factor, first):
        return sum(int(piecewise.BYTE_VALUES[data[j]]) * pow(factor, abs(j - first), word) for j in range(start, stop)) % word

    ends = []
    for i in range(len(data)):
        mixed = value(max(0, i - piecewise.SPAN + 1), i + 1, piecewise.INVERSE, i) * 0xD6E8FEB86659FD93 % word >> 33
        ends += [(i + 1, mixed)] * (mixed % piecewise.LEAST == 0)

    def borders(size):
        return [at for at, mixed in ends if mixed % size == 0]

    def characters(size):
        cuts = [0, *borders(size)[: piecewise.CHUNKS - 1], len(data)]
        hashes = [value(a, b, piecewise.BASE, a) * 0xA0761D6478BD642F % word for a, b in zip(cuts, cuts[1:]) if a < b]
        return "".join(chr(piecewise.CHARACTERS[h >> 58]) for h in hashes)

    size = piecewise.LEAST
    while size * piecewise.CHUNKS < len(data):
        size *= 2
    while size > piecewise.LEAST and len(borders(size)) < piecewise.CHUNKS // 2:
        size //= 2
    return f"{size}:{characters(size)}:{characters(2 * size)}"


@pytest.mark.parametrize("n", [0, 1, 6, 7, 8, 50, 192, 193, 700, 3000])
def test_fingerprints_equal_plain_python(n):
    rng = random.Random(n)
    for alphabet in ("a", "ab ", "abcdefgh ijklé漢\n"):
        text = "".join(rng.choice(alphabet) for _ in range(n))
        assert piecewise.fingerprint(text) == plain_fingerprint(text)


def test_edited_pairs_of_few(spark):
    assert piecewise.edited_pairs(documents(spark, [])).count() == 0
    (only,) = piecewise.edited_pairs(documents(spark, [(4, "abcdef", "en")])).collect()
    assert only["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and only["near_next"] == 1.0
    rows = piecewise.edited_pairs(documents(spark, [(1, None, "en"), (2, "", "en"), (3, "text", "en")])).collect()
    assert {(r["doc_id"], r["near_next"]) for r in rows} == {(1, 0.0), (2, 1.0), (3, 0.0)}


def test_likeness_follows_edits(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefghij klmnop") for _ in range(6000))
    texts = [base, base[:3000] + "XY" + base[3000:], "".join(rng.choice("abcdefghij klmnop") for _ in range(6000)), base * 2]
    prints = [piecewise.fingerprint(t) for t in texts]
    df = spark.createDataFrame([(prints[0], p) for p in prints], "a string, b string")
    same, edited, other, longer = [r[0] for r in df.select(piecewise.likeness(F.col("a"), F.col("b"))).collect()]
    assert same == 1.0 and edited > 0.9 and other < 0.3 and 0 <= longer <= 1


# ---- SentencePiece


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abt he▁\n\t<>/é漢😀12"), st.characters(codec="utf-8", exclude_characters="\0")), max_size=40))
def test_pieces_are_those_of_the_library(text):
    import sentencepiece

    global LIBRARY
    LIBRARY = globals().get("LIBRARY") or sentencepiece.SentencePieceProcessor(model_file=transducer.public_model())
    ours = transducer.compiled(transducer.public_model())
    ids = ours.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text)
    assert ours.decode(ids) == LIBRARY.decode(LIBRARY.encode(text)) == text.replace("▁", " ")


def test_unigram_takes_the_least_weight():
    pieces = {p: (i, s) for i, (p, s) in enumerate([("a", -3.0), ("b", -3.0), ("ab", -2.0), ("abc", -9.0), ("c", -1.0), ("▁", -1.0)])}
    model = transducer.Transducer(pieces, None, merges=False, rules={"ﬁ": "ab"}, unknown=99)
    assert np.frombuffer(model.encode("abc"), "<u4").tolist() == [5, 2, 4]  # 1 + 2 + 1 beats 1 + 9
    assert np.frombuffer(model.encode("ﬁx"), "<u4").tolist() == [5, 2, 99]
    assert model.encode("") == b""


def varint(n):
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)


def entry(number, value):
    """A field of a protocol buffers message."""
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model_of(pieces, kind, with_bytes=False, normaliser=b"", trainer=b""):
    """A model file of pieces with given scores: kind 1 is unigram, 2 merges."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] * with_bytes
    rows += [(p, score, 1) for p, score in pieces]
    out = b"".join(entry(1, entry(1, p.encode()) + entry(2, score) + entry(3, k)) for p, score, k in rows)
    return out + entry(2, entry(3, kind) + (entry(35, 1) if with_bytes else b"") + trainer) + entry(3, entry(1, b"identity") + normaliser)


def made_up_pieces(seed, ties):
    rng = random.Random(seed)
    texts = {"▁", "a", "b", "t", "h", "e", "▁a"} | {"".join(rng.choice("abthe▁é") for _ in range(rng.randint(1, 6))) for _ in range(80)}
    return [(t, -float(rng.randint(1, 6)) if ties else -rng.uniform(0.5, 14)) for t in sorted(texts)]


@pytest.mark.parametrize("extra", [0, 1])
@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("with_bytes", [False, True])
@pytest.mark.parametrize("ties", [False, True])
def test_unigram_models_are_encoded_as_by_the_library(ties, with_bytes, prefix, extra):
    import sentencepiece

    rng = random.Random(5)
    for seed in range(6):
        model = model_of(made_up_pieces(seed, ties), 1, with_bytes, entry(3, prefix) + entry(4, extra))
        library, ours = sentencepiece.SentencePieceProcessor(model_proto=model), transducer.parsed(model)
        assert not ours.merges
        for size in [0, 1, 2, 3, 5, 8, 13, 21, 34, 400] * 4:
            text = "".join(rng.choice("abthe  é漢xé\n") for _ in range(size))
            assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text), (seed, text)


@pytest.mark.parametrize(
    "model",
    [
        model_of([("a", -1.0)], 3),
        model_of([("a", -1.0)], 1, normaliser=entry(2, b"table")),
        model_of([("a", -1.0)], 1, normaliser=entry(5, 0)),
        model_of([("a", -1.0)], 1, trainer=entry(24, 1)),
        model_of([("a", -1.0)], 1) + entry(1, entry(1, b"own") + entry(3, 4)),
        model_of([("a", -1.0)], 2) + entry(1, entry(1, b"unused") + entry(3, 5)),
    ],
)
def test_models_that_ask_for_more_raise(model):
    with pytest.raises(ValueError):
        transducer.parsed(model)


def test_pieces_round_trip_on_tables(spark):
    docs = documents(spark, ODD)
    back = transducer.decode(transducer.encode(docs)).collect()
    assert [r["decoded"] for r in back] == [(t or "").replace("▁", " ") for _, t, _ in ODD]
    told = transducer.digests(docs).collect()
    assert all(r["round_trip"] for r in told) and told[0]["n_pieces"] == 0
    assert transducer.digests(documents(spark, [])).count() == 0


# ---- packing


def check_packed(rows, encode, pieces, window):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for p in pieces:
        by_doc.setdefault((p["doc"], p["doc_tokens"]), []).append(p)
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    for key, text in rows:
        ids = [*encode(text or ""), 0]
        own = sorted(by_doc[key, len(ids)], key=lambda p: p["start"])
        assert [p["ids_crc32"] for p in own] == [
            zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for p in own
        ]
        copies = sum(r == (key, text) for r in rows)
        assert sum(p["length"] for p in own) == copies * len(ids)


def test_pack(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"word{rng.randrange(999)}" for _ in range(rng.randrange(0, 400)))) for i in range(150)]
    rows += [(i, t) for i, t, _ in ODD] + [(1000 + i, "same text " * 40) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("salt", F.lit(1)).withColumn("length", F.lit(2))
    pieces = packing.pack(spark, docs, part=16).collect()
    check_packed(rows, packing.byte_bpe_ids, pieces, 1024)
    total, sequences = sum(p["length"] for p in pieces), len({p["sequence_id"] for p in pieces})
    assert sequences <= 1.05 * total / 1024 + 1
    assert packing.pack(spark, docs.limit(0)).count() == 0


def test_ids_are_those_of_the_vocabulary():
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    for text in ["", "Hello, world's  end\n\n\t x", "é漢😀ä²¹\u0085\u00a0\u3000", "<|endoftext|> a", "a" * 5000, "1234 5.6e7__x"]:
        assert packing.byte_bpe_ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_recognised_in_texts(spark):
    """As the library does by default, without ``encode_special_tokens``."""
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = ["", "a b", f"a {mark} b", mark, mark * 3, f"{mark} a\n\n{mark}  x", f"<|{mark}|>", "<|endoftext|", f"é{mark}漢 " * 500]

    def encode(text):
        return library.encode(text, add_special_tokens=False).ids

    for text in texts:
        assert packing.vocabulary_ids(text).tolist() == encode(text)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check_packed(list(enumerate(texts)), encode, packing.pack(spark, docs).collect(), 1024)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200))
def test_plan_uses_every_piece_once(lengths):
    histogram = np.bincount(np.array(lengths, int), minlength=33)
    used = np.zeros(33, int)
    for pattern, times in packing.plan(histogram, 32):
        assert sum(pattern) <= 32 and times > 0
        for n in pattern:
            used[n] += times
    assert (used == histogram).all()


def test_solve_finds_an_exact_cover():
    histogram = np.zeros(16, int)
    histogram[[10, 6, 5, 3, 8]] = [7, 5, 4, 2, 6]
    combos = packing.combinations(16, np.nonzero(histogram)[0])
    x = packing.solve(combos, histogram, 3000)
    used = sum(np.bincount(combos[:, i], x, 16) for i in range(3))
    assert (x >= 0).all() and abs((used - histogram)[1:]).max() < 1.5


# ---- chat


@given(st.text(alphabet="\\#</turn>hcd: \n", max_size=30), st.text(alphabet="\\#:d <", max_size=8))
def test_escapes_are_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.parse(chat.marked([(role, text)] * 3)) == [(role, text)] * 3
    assert "</turn>" not in chat.escape(text) and "###" not in chat.escape(text)


def turns(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, c string, r int")


def test_spans_locate_texts(spark):
    rows = [(1, 1, "assistant", "b </turn>"), (1, 0, "user", "a ### x"), (1, 2, None, None), (None, 0, "assistant", "\\h"),
            (2, None, "user", "last"), (2, 5, "user", "first"), *[(3, i, "assistant", f"t{i}") for i in range(60)]]
    found = {}
    for r in chat.format_turns(turns(spark, rows)).collect():
        found.setdefault(r["conv_id"], []).append(r)
    for conv, spans in found.items():
        whole = "".join(s["formatted"] for s in spans)
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0))
        assert whole == chat.marked([(r[2] or "", r[3] or "") for r in own])
        for s, r in zip(spans, own, strict=True):
            assert whole[s["start"] : s["end"]] == s["formatted"]
            assert chat.unescape(whole[s["text_start"] : s["text_end"]]) == (r[3] or "") and not s["rewrites"]
    assert chat.format_turns(turns(spark, [])).count() == 0
    (none,) = [r for r in chat.read_back(chat.format_turns(turns(spark, rows))).collect() if r["conv_id"] is None]
    assert (none["n_turns"], none["loss_chars"], none["loss_sha256"]) == (1, 2, hashlib.sha256(b"\\h").hexdigest())


def test_templates_that_rewrite_or_look_back(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"text {i}") for i in range(8)]

    def rewriting(given):  # drops what was said before the last two turns
        return "<s>" + "".join(f"[{r}]{t}" for r, t in given[-2:])

    told = chat.format_turns(turns(spark, rows), template=rewriting).collect()
    assert [t["rewrites"] for t in told] == [False, False, *[True] * 6] and told[2]["formatted"] is None

    def numbered(given):
        return "".join(f"{i}{t}\n" for i, (_, t) in enumerate(given))

    assert all(not t["rewrites"] for t in chat.format_turns(turns(spark, rows), template=numbered).collect())


def long_conversation():
    return [(1, n, ("user", "assistant")[n % 2], f"text {n} <{n % 5}>") for n in range(60)]


def test_a_rewrite_is_found_at_any_turn(spark):
    """A template that keeps the last 32 turns changes what it wrote at the 33rd."""

    def forgetful(given):
        return "".join(f"[{role}] {text}\n" for role, text in given[-32:])

    told = chat.format_turns(turns(spark, long_conversation()), template=forgetful).orderBy("turn_number").collect()
    assert [t["rewrites"] for t in told] == [False] * 32 + [True] * 28
    assert all(t["formatted"] is None and t["text_start"] is None for t in told[32:])


def test_the_built_in_template_is_rendered_by_whole_prefixes(spark):
    """It is a black box like any other: what wraps it is found to rewrite, and every prefix and probe goes through it."""

    @functools.wraps(chat.marked)
    def forgetful(given):
        return chat.marked(given[-32:])

    told = chat.format_turns(turns(spark, long_conversation()), template=forgetful).orderBy("turn_number").collect()
    assert [t["rewrites"] for t in told] == [False] * 32 + [True] * 28

    seen = []

    @functools.wraps(chat.marked)
    def watched(given):
        seen.append(len(given))
        return chat.marked(given)

    renderer = chat.Renderer(watched, getattr(watched, "looks_back", None))
    for _, _, role, text in long_conversation():
        renderer.add((role, text))
    assert seen == [n for n in range(1, 61) for _ in range(3)]


@pytest.mark.parametrize("looks_back", [None, 0, 2])
def test_turns_of_long_conversations_are_located(spark, looks_back):
    """By whole prefixes with numbered turns, and with templates that declare how far they look back."""

    def numbered(given):
        return "<s>" + "".join(f"{n}. {role}: {text}\n" for n, (role, text) in enumerate(given))

    def answering(given):
        return "".join(f"{role} after {given[n - 1][0] if n and looks_back else ''}: {text}\n" for n, (role, text) in enumerate(given))

    template = numbered if looks_back is None else answering
    rows = long_conversation()
    told = chat.format_turns(turns(spark, rows), template=template, looks_back=looks_back).orderBy("turn_number").collect()
    full = template([(role, text) for _, _, role, text in rows])
    assert "".join(t["formatted"] for t in told) == full
    assert [full[t["text_start"] : t["text_end"]] for t in told] == [text for *_, text in rows]
    assert not any(t["rewrites"] for t in told)
