"""The ten operators against brute force, and on awkward rows and empty tables."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from hearth.llm import ann, bpe, bwt, lexicon, mixing, near_dup, packing, pii, substrings, toxicity
from hearth.llm.exact_dedup import drop_exact_copies, exact_dedup
from hearth.llm.line_dedup import line_dedup
from tests.conftest import SF0001
from tests.llm.conftest import AWKWARD


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# ---------------------------------------------------------------- 1: pseudonyms

def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(digits[::-1])) % 10 == 0


def slow_feistel(key, kind, left, right, a, b):
    for i in range(pii.ROUNDS):
        def f(size, x):
            return int(hashlib.sha256(f"{key}|{kind}|{size}|{i}|{x}".encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            left = (left + f(a, right)) % a
        else:
            right = (right + f(b, left)) % b
    return left, right


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in pii.pseudonymise(df, key).orderBy("row.doc_id").collect()]


def test_feistel_matches_brute_force(spark):
    out = replaced(spark, ["ip 10.20.30.40 end", "on 1999-12-31.", "on 31/12/1999.", "card 4111 1111 1111 1111!"])
    l, r = slow_feistel("k", "ip", 10 * 256 + 20, 30 * 256 + 40, 65536, 65536)
    assert out[0] == f"ip {l // 256}.{l % 256}.{r // 256}.{r % 256} end"
    day = (np.datetime64("1999-12-31") - np.datetime64("1800-01-01")).astype(int)
    l, r = slow_feistel("k", "date", day // 773, day % 773, 189, 773)
    new = str(np.datetime64("1800-01-01") + (l * 773 + r))
    assert out[1] == f"on {new}."
    assert out[2] == f"on {new[8:]}/{new[5:7]}/{new[:4]}."
    l, r = slow_feistel("k", "card", 4111111, 11111111, 10 ** 7, 10 ** 8)
    body = f"{l:07d}{r:08d}"
    digits = re.sub(r"\D", "", out[3])
    assert digits[:15] == body and luhn(digits) and re.fullmatch(r"card \d{4} \d{4} \d{4} \d{4}!", out[3])


def test_pseudonyms_are_a_permutation_and_keep_their_format(spark):
    values = [f"{a}.{b}.0.{c}" for a in range(1, 5) for b in range(0, 250, 50) for c in range(0, 250, 50)]
    values += [f"{k:03d}-{k % 99 + 1:02d}-{k * 9 % 9999 + 1:04d}" for k in range(1, 60)]
    values += [f"name.{k}@mail.example.com" for k in range(50)] + [f"+1 (200) 555-{k:04d}" for k in range(50)]
    out = replaced(spark, values)
    assert len(set(out)) == len(set(values)) and all(a != b for a, b in zip(values, out))
    shape = [re.sub(r"[a-z]", "a", re.sub(r"\d+" if "@" not in v and v.count(".") == 3 else r"\d", "9", v)) for v in values]
    assert shape == [re.sub(r"[a-z]", "a", re.sub(r"\d+" if "@" not in v and v.count(".") == 3 else r"\d", "9", v)) for v in out]
    assert replaced(spark, values[:3], "other") != out[:3]


def test_values_that_fail_validation_stay(spark):
    same = ["card 4111111111111112", "ip 300.1.1.1", "day 2001-02-30", "ssn 666-12-1234", "v1.2.3.4.5", "", None]
    assert replaced(spark, same) == same
    both = replaced(spark, ["x 4111111111111111 y 4111111111111111", "4111111111111111"])
    card = both[1]
    assert both[0] == f"x {card} y {card}"


def test_phones_by_brute_force(spark):
    forms = {"(415) 555-2671": 0, "415-555-2671": 0, "415.555.2671": 0, "+1 415 555 2671": 1, "+442079460958": 2,
             "+44 20 7946 0958": 2, "+49 30 901820": 2, "+33 1 23 45 67 89": 2, "+353 1 679 1977": 3, "+1 (017) 555-7713": 1}
    for value, out in zip(forms, replaced(spark, list(forms))):
        digits = re.sub(r"\D", "", value)
        code, rest = digits[:forms[value]], digits[forms[value]:]
        h = len(rest) // 2
        l, r = slow_feistel("k", "phone", int(rest[:h]), int(rest[h:]), 10 ** h, 10 ** (len(rest) - h))
        new = iter(code + f"{l:0{h}d}{r:0{len(rest) - h}d}")
        assert out == re.sub(r"\d", lambda _: next(new), value)


def test_ssn_by_brute_force(spark):
    def place(area, group, serial):
        return (area - 2 if area > 666 else area - 1) * 99 + group - 1, serial - 1
    l, r = slow_feistel("k", "ssn", *place(123, 45, 6789), 898 * 99, 9999)
    area = l // 99 + (2 if l // 99 >= 665 else 1)
    want = f"{area:03d}-{l % 99 + 1:02d}-{r + 1:04d}"
    assert replaced(spark, ["123-45-6789", "123 45 6789"]) == [want, want.replace("-", " ")]


def test_dates_in_both_orders(spark):
    day = (np.datetime64("2003-02-01") - np.datetime64("1800-01-01")).astype(int)
    l, r = slow_feistel("k", "date", day // 773, day % 773, 189, 773)
    new = (np.datetime64("1800-01-01") + (l * 773 + r)).astype(object)
    assert replaced(spark, ["1/2/2003", "01/02/2003"]) == [f"{new.day}/{new.month}/{new.year}", f"{new.day:02d}/{new.month:02d}/{new.year}"]
    # dates with a day over 12, in the order m/d, are permuted among themselves
    late = [d.astype(object) for d in np.arange(np.datetime64("1800-01-01"), np.datetime64("2200-01-01")) if d.astype(object).day > 12]
    some = list(range(0, len(late), 4_999)) + [len(late) - 1]
    want = []
    for k in some:
        l, r = slow_feistel("k", "late date", k // pii.LATE, k % pii.LATE, 9, pii.LATE)
        d = late[l * pii.LATE + r]
        want.append(f"{d.month:02d}/{d.day:02d}/{d.year}")
    assert len(late) == 9 * pii.LATE
    assert replaced(spark, [f"{late[k].month:02d}/{late[k].day:02d}/{late[k].year}" for k in some]) == want
    same = ["2/30/2001", "13/13/2001", "12/31/1799", "1/2/03"]
    assert replaced(spark, same) == same


def test_names_ibans_and_ipv6_by_brute_force(spark):
    def shift(half, other, kind, i, classes):
        stream = hashlib.sha256(f"k|{kind}|{i}|{other}".encode()).hexdigest()
        out = ""
        for k, c in enumerate(half):
            x = int(stream[k % 31 * 2:k % 31 * 2 + 3], 16)
            low, size = next(((a, b) for a, b in classes if a <= ord(c) < a + b), (ord(c), 1))
            out += chr(low + (ord(c) - low + x) % size)
        return out

    def name(text, kind, classes=pii.CLASSES):
        l, r = text[:len(text) // 2], text[len(text) // 2:]
        for i in range(pii.ROUNDS):
            l, r = (shift(l, r, kind, i, classes), r) if i % 2 == 0 else (l, shift(r, l, kind, i, classes))
        return l + r

    names = ["josé.müller", "иван", "λένα.7", "李小龍", "a", "x_1", "łukasz"]
    assert replaced(spark, [f"to {n}@example.com." for n in names]) == [f"to {name(n, 'email')}@example.com." for n in names]
    account = name("WEST12345698765432", "iban")
    rest = int("".join(str(int(c, 36)) for c in account + "GB00")) % 97
    iban = f"GB{98 - rest:02d}{account}"
    spaced = " ".join(iban[k:k + 4] for k in range(0, 22, 4))
    assert replaced(spark, ["GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"]) == [iban, spaced]
    six = name("20010db885a3000000008a2e03707334", "ipv6", pii.HEX)
    full = ":".join(six[k:k + 4] for k in range(0, 32, 4))
    short = name("2001db81", "ipv6", pii.HEX)
    assert replaced(spark, ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "at 2001:db8::1"]) == [full, f"at {short[:4]}:{short[4:7]}::{short[7]}"]
    same = ["GB82WEST12345698765431", "std::vector abc::def 12:30:45", "123456789", "+100 200 300", "4155552671"]
    assert replaced(spark, same) == same


def test_pii_edges(spark, awkward, empty):
    rows = pii.pseudonymise(awkward, "k").select("row.n", "text", "n_replaced").collect()
    assert {r.n: r.text for r in rows} == {k: t for k, (_, t) in enumerate(AWKWARD)}
    assert all(r.n_replaced == 0 for r in rows)
    assert pii.pseudonymise(empty, "k").count() == 0


# ---------------------------------------------------------------- 2: mixing

def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 500, 400)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n_tokens long, posterior array<double>")
    total = float(n.sum())
    targets = {"a": 0.5 * total, "b": 0.3 * total, "c": 0.2 * total}
    steps, reached = mixing.fit_rates(df, ["a", "b", "c"], targets)
    assert all(abs(reached[d] - t) <= 0.0021 * t for d, t in targets.items())
    rate = df.select("n_tokens", "posterior", mixing.rate_after(F.col("posterior"), steps)["now"].alias("r")).collect()
    assert min(r.r for r in rate) >= 0
    sums = sum(r.r * r.n_tokens * np.array(r.posterior) for r in rate)
    assert np.allclose(sums, [reached[d] for d in "abc"])
    # the same steps, one document at a time
    for row in rate[:20]:
        now = before = 1.0
        for s in steps:
            now, before = max(0.0, now + s[0] * (now - before) - sum(a * b for a, b in zip(row.posterior, s[1:]))), now
        assert now == pytest.approx(row.r, abs=1e-9)


def test_rates_out_of_reach_stay_nonnegative(spark):
    df = spark.createDataFrame([(10, [0.9, 0.1]), (10, [0.8, 0.2])], "n_tokens long, posterior array<double>")
    steps, reached = mixing.fit_rates(df, ["a", "b"], {"a": 0.0, "b": 20.0})
    assert all(r.r >= 0 for r in df.select(mixing.rate_after(F.col("posterior"), steps)["now"].alias("r")).collect())
    assert reached["b"] < 20


def test_domains_are_learned_and_rows_kept(spark, docs, labels, awkward, empty):
    out, report = mixing.mix(docs, labels)
    assert out.count() == docs.count() and report["domains"] == ["good", "poor", "toxic"]
    rows = (out.select("row.doc_id", "posterior").join(mixing.domain_labels(labels), F.col("doc_id") == F.col("id")).collect())
    right = np.mean([report["domains"][int(np.argmax(r.posterior))] == r.domain for r in rows])
    assert right > 0.9
    out, _ = mixing.mix(awkward, labels, keep_text=True)
    assert sorted(out.select("row.n").toPandas()["n"]) == list(range(len(AWKWARD)))
    assert out.select("row.*").columns == awkward.columns
    copies = mixing.draw_copies(out.withColumn("rate", F.lit(2.0)))
    assert copies.count() == 2 * len(AWKWARD) and copies.columns == awkward.columns
    assert mixing.mix(empty, labels)[0].count() == 0
    assert mixing.mix(docs, labels.limit(0))[0].count() == docs.count()


# ---------------------------------------------------------------- 3: BPE

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.vocabulary_path())


def test_lexicon_is_minimal_and_exact():
    words = sorted({("".join(random.Random(k).choices("abc", k=k % 7 + 1))).encode() for k in range(400)})
    lex = lexicon.build(words)
    probe = words + [b"abcabcabcabc", b"d", b"", b"a\0", b"x" * 100]
    assert lexicon.ranks(lex, probe).tolist() == [*range(len(words)), *[-1] * 5]
    # minimal: no two states have the same future
    children = defaultdict(dict)
    for key, target in zip(lex["keys"].tolist(), lex["targets"].tolist()):
        children[key // 256][key % 256] = target
    seen = {(int(f), tuple(sorted(children[s].items()))) for s, f in enumerate(lex["final"])}
    assert len(seen) == len(lex["final"])
    assert lexicon.ranks(lexicon.build([]), [b"a"]).tolist() == [-1]


def test_lexicon_file_round_trip(tmp_path):
    lex = lexicon.build([b"ab", b"abc", b"b"])
    back = lexicon.load(str(tmp_path / "x"), lexicon.save(str(tmp_path / "x"), lex))
    assert lexicon.ranks(back, [b"abc", b"b", b"c"]).tolist() == [1, 2, -1]


def test_merges_match_the_library(library):
    vocab = bpe.Vocabulary(bpe.vocabulary_path())
    encoder, decoder = bpe.Encoder(vocab, None), bpe.Decoder(vocab)
    r = random.Random(1)
    texts = ["", " ", "a" * 5000, "!" * 300, "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|endoftext", "ΑΣ Σ İ ﬁ ²Ⅷ",
             "'s'll 'SWORD don't", "a\x1cb !\x1c! \x85\xa0z"]
    texts += ["".join(r.choice("aΣσ's<|endoftext|> \x1c\x85́éEİ'llA1²Ⅷ中") for _ in range(300)) for _ in range(60)]
    texts += ["".join(chr(r.randrange(1, 0xD7FF)) + r.choice(["", "a", " "]) for _ in range(200)) for _ in range(60)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = encoder.encode([t])[0]
        assert got.tolist() == want
        assert decoder.decode(got.astype("<u4")) == library.decode(want, skip_special_tokens=False)


def test_batched_merges_equal_single_ones(texts):
    vocab = bpe.Vocabulary(bpe.vocabulary_path())
    words = sorted({w.encode() for t in texts.values() for w in vocab.units(vocab.normalise(t))}) + [b"a" * k for k in range(1, 80)]
    ids, lengths = vocab.merge_all(words)
    single = [vocab.merge(w) for w in words]
    assert lengths.tolist() == [len(x) for x in single] and ids.tolist() == [x for m in single for x in m]


def test_strings_over_all_planes_match_the_library(library):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.vocabulary_path()), None)
    r = random.Random(7)
    points = [k for k in range(1, 0x110000) if not 0xD800 <= k < 0xE000]
    marks = [k for k in points if unicodedata.category(chr(k)) in ("Mn", "Mc", "Cn") and k < 0x1F000]
    texts = ["".join(chr(k) for k in r.choices(points, k=60)) for _ in range(4000)]
    texts += ["e" + "".join(chr(k) for k in r.choices(marks, k=6)) + "a" for _ in range(8000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, x, y in zip(texts, encoder.encode(texts), want) if x.tolist() != y] == []


def test_every_letter_splits_like_the_library(library):
    vocab = bpe.Vocabulary(bpe.vocabulary_path())
    encoder = bpe.Encoder(vocab, None)
    for form in ("a{}", "!{}"):
        texts = [form.format(chr(k)) for k in range(1, 0x3400) if not 0xD800 <= k < 0xE000]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in encoder.encode(texts)] == want


def latin_texts():
    r = random.Random(3)
    alphabet = "".join(map(chr, range(256))) + "aaeestmdrvl''''''  " * 12
    texts = ["".join(r.choices(alphabet, k=r.randrange(60))) for _ in range(2000)]
    return texts + ["", "'", "don't we'll you'RE 'sample ''s x's's 're' 'l 'v", "a" * 3000, "a\0 a b\0\0 b", "aaaaaaaab aaaaaaaac"]


def test_latin_texts_are_split_without_the_pattern(library, monkeypatch):
    texts = latin_texts()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    vocab = bpe.Vocabulary(bpe.vocabulary_path())
    mixed = bpe.Encoder(vocab, None)
    assert [x.tolist() for x in mixed.encode(texts)] == want
    assert list(mixed.index) == ["a" * 3000] and len(mixed.table)       # only a very long word takes the pattern
    texts, want = zip(*((t, w) for t, w in zip(texts, want) if len(t) <= bpe.LONGEST_CUT and "<|" not in t))
    with monkeypatch.context() as m:
        m.setattr(vocab, "units", None)     # one call of the pattern for each text is what took the time
        encoder = bpe.Encoder(vocab, None)
        assert [x.tolist() for x in encoder.encode(list(texts))] == list(want)
        assert not encoder.index and len(encoder.table)
        m.setattr(bpe, "CACHE_WORDS", 50)
        few = bpe.Encoder(vocab, None)
        for t, w in zip(texts[:200], want):
            assert few.encode([t])[0].tolist() == w and len(few.table) <= 50
    # words that share a hash go through the pattern
    monkeypatch.setattr(bpe, "hash_words", lambda buf, starts, lengths: (lengths % 2).astype(np.uint64))
    clash = bpe.Encoder(vocab, None)
    assert [clash.encode([t])[0].tolist() for t in texts[:300]] == list(want[:300])
    assert clash.index


@pytest.mark.parametrize("clash", [False, True])
def test_word_counts_equal_those_of_the_pattern(monkeypatch, clash):
    texts = latin_texts() + ["中文 abc abc", "x<|endoftext|>abc", "ÀÉ àé éa"]
    vocab = bpe.Vocabulary(bpe.vocabulary_path())
    want = Counter(w for t in texts for part in bpe.split_chunks(vocab, t) if part and isinstance(part[0], str)
                   for chunk in part for w in vocab.words(chunk))
    if clash:
        monkeypatch.setattr(bpe, "hash_words", lambda buf, starts, lengths: (lengths % 2).astype(np.uint64))
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k:k + 20])], ["t"]) for k in range(0, len(texts), 20)]
    got = Counter()
    for out in bpe._count_words(bpe.vocabulary_path(), 200)(iter(batches)):
        out.validate(full=True)
        for w, n in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            got[w] += n
    assert got == want


def test_encode_in_spark(spark, awkward, empty, library):
    out = bpe.decode(bpe.encode(awkward, decoded=True, lexicon_words=5).withColumnRenamed("decoded", "first"))
    rows = out.select("row.n", "n_tokens", "ids", "first", "decoded").collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        want = library.encode(AWKWARD[r.n][1] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.first == r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(empty).count() == 0


# ---------------------------------------------------------------- 4: substrings

def slow_removal(rows, min_len=100):
    seen, out = set(), {}
    for i, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - min_len + 1):
            w = b[p:p + min_len]
            if w in seen:
                gone[p:p + min_len] = 1
            seen.add(w)
        kept = bytes(c for c, x in zip(b, gone) if not x)
        out[i] = (len(b), len(b) - len(kept), int((np.diff(gone, prepend=0) == 1).sum()), sha(kept))
    return out


def removal(df, **options):
    rows = substrings.remove_repeats(df, **options).select(
        "row.doc_id", "n_bytes", "n_removed", F.size("span_start").alias("s"), F.sha2("kept", 256).alias("k")).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.s, r.k) for r in rows}


def test_interval_expansion_finds_equal_prefixes():
    r = random.Random(3)
    for _ in range(150):
        n, letters = r.choice([6, 8, 12, 30]), r.choice([1, 2, 4])
        parts = [bytes(r.randrange(97, 97 + letters) for _ in range(r.randrange(60))) for _ in range(r.randrange(1, 12))]
        text = b"\xff".join(parts + [parts[0]] * r.randrange(4)) + b"\xff"
        sa, run = bwt.long_prefix_runs(np.frombuffer(text, np.uint8), n)
        of = dict(zip(sa.tolist(), run.tolist()))
        want, got = defaultdict(set), defaultdict(set)
        for p in range(len(text) - n + 1):
            if b"\xff" not in text[p:p + n]:
                want[text[p:p + n]].add(p)
                got[of[p]].add(p)
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_removal_matches_brute_force(spark, docs, texts):
    want = slow_removal(sorted(texts.items()))
    assert removal(docs) == want
    assert removal(docs, hot=2) == want      # with split groups


def test_removal_of_random_overlaps(spark):
    r = random.Random(9)
    base = "".join(r.choice("ab ") for _ in range(400))
    rows = [(k, base[r.randrange(300):][:r.randrange(90, 400)] + r.choice(["", "é", "z" * 250]) + base[:r.randrange(200)]) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert removal(df) == slow_removal(rows)


def test_removal_edges(spark, awkward, empty):
    rows = substrings.remove_repeats(awkward).select("row.n", "n_bytes", "n_removed").collect()
    got = {r.n: (r.n_bytes, r.n_removed) for r in rows}
    assert len(got) == len(AWKWARD) and got[3] == got[4] == (0, 0) and got[0] == (48, 0)
    long_text = AWKWARD[8][1]
    assert got[8] == (len(long_text), len(long_text) - 5)       # the period stays once
    assert substrings.remove_repeats(empty).count() == 0


def test_removal_with_repeated_rows_and_rows_without_id(spark):
    r = random.Random(12)
    a, b, c, d = ("".join(r.choice("abcdefgh ") for _ in range(160)) for _ in range(4))
    rows = [(1, a), (1, a), (2, b + a), (3, c + "x" + b), (3, d), (3, c + "x" + b), (None, d + c), (None, d + c), (None, a + "y" + d),
            (4, "é" * 120), (4, "é" * 120)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int")

    def place(x):
        h = xxhash.xxh64_intdigest(x[1].encode(), seed=42)
        return (1 << 63) - 1 if x[0] is None else x[0], h - (1 << 64) if h >> 63 else h
    want = slow_removal([(x, x[1]) for x in sorted(set(rows), key=place)])
    for hot in (substrings.HOT, 2):
        out = substrings.remove_repeats(df, hot=hot).select(
            "row.k", "n_bytes", "n_removed", F.size("span_start").alias("s"), F.sha2("kept", 256).alias("h")).collect()
        assert {x.k: (x.n_bytes, x.n_removed, x.s, x.h) for x in out} == {k: want[x] for k, x in enumerate(rows)}


# ---------------------------------------------------------------- 5: toxicity

def test_noisy_or_learns_the_bad_words():
    r = random.Random(4)
    bags, y = [], []
    for _ in range(400):
        toxic = r.random() < 0.3
        sents = [[r.choice([1, 2, 3])] for _ in range(r.randrange(1, 5))]
        if toxic:
            sents[r.randrange(len(sents))].append(0)
        bags.append([sorted(set(s)) for s in sents])
        y.append(int(toxic))
    m = toxicity.fit_noisy_or(bags, np.array(y), np.ones(400), 4)
    assert m["weights"][0] > 3 and max(m["weights"][1:]) < 1
    empty = toxicity.fit_noisy_or([], np.zeros(0), np.zeros(0), 0)
    assert np.isfinite(empty["leak"])


def test_held_out_accuracy_and_spans(spark):
    folder = SF0001.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = toxicity.toxicity(docs, labels).select("row.doc_id", "row.text", "score", "predicted", "span_start", "span_end")
    rows = out.join(labels, "doc_id").filter(toxicity.fold(F.col("doc_id")) == 0).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    for r in rows:
        assert 0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.5) == bool(r.span_start)
        assert all(0 <= a < b <= len(r.text) for a, b in zip(r.span_start, r.span_end))


def test_toxicity_edges(spark, docs, labels, awkward, empty):
    index, model = toxicity.train_model(docs, labels)
    rows = toxicity.score_documents(awkward, index, model).select("row.n", "score", "predicted").collect()
    by = {r.n: r.score for r in rows}
    assert len(rows) == len(AWKWARD) and by[1] == by[2] and by[3] == by[4] == by[5] and max(by.values()) < 0.5
    assert toxicity.toxicity(empty, labels).count() == 0
    blank = toxicity.toxicity(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert blank.filter("score < 0 or score > 1").count() == 0 and blank.count() == docs.count()


# ---------------------------------------------------------------- 6: packing

def test_best_fit_decreasing_matches_brute_force():
    r = random.Random(8)
    for _ in range(100):
        capacity = r.choice([5, 8, 31, 100])
        lengths = [r.randrange(1, capacity + 1) for _ in range(r.randrange(60))]
        rows = packing.best_fit_decreasing(lengths, capacity)
        assert sorted(k for row in rows for k in row) == list(range(len(lengths)))
        free, counts = [], []
        for x in sorted(lengths, reverse=True):
            fits = [k for k, f in enumerate(free) if f >= x]
            if fits:
                k = min(fits, key=lambda k: free[k])
                free[k] -= x
            else:
                free.append(capacity - x)
        counts = sorted(capacity - sum(lengths[k] for k in row) for row in rows)
        assert counts == sorted(free)


@pytest.mark.parametrize("capacity,window", [(64, 500), (8192, 4_000_000)])
def test_packing_is_lossless(spark, awkward, empty, capacity, window):
    rows = packing.pack(packing.byte_ids(awkward, "n"), capacity=capacity, window_tokens=window).collect()
    assert len({r.pack_id for r in rows}) == len(rows)
    got = defaultdict(list)
    for r in rows:
        ids, pos = (np.frombuffer(bytes(x), "<u2") for x in (r.input_ids, r.position_ids))
        assert len(ids) == len(pos) == capacity and not ids[r.cu_seqlens[-1]:].any()
        for k, (d, s) in enumerate(zip(r.doc_ids, r.doc_starts)):
            a, b = r.cu_seqlens[k:k + 2]
            assert (pos[a:b] == np.arange(b - a)).all()
            got[d].append((s, (ids[a:b] - packing.BYTE_OFFSET).astype(np.uint8).tobytes()))
    for k, (_, t) in enumerate(AWKWARD):
        assert b"".join(x for _, x in sorted(got[k])) == (t or "").encode()
    assert packing.pack(packing.byte_ids(empty)).count() == 0


def test_packing_of_token_ids(spark, awkward):
    encoded = bpe.encode(awkward)
    want = {r.n: bytes(r.ids) for r in encoded.select("row.n", "ids").collect()}
    rows = packing.pack(encoded.select("row.n", "ids"), "n", capacity=512, id_bytes=4).collect()
    got = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.input_ids), "<u4")
        for k, (d, s) in enumerate(zip(r.doc_ids, r.doc_starts)):
            a, b = r.cu_seqlens[k:k + 2]
            got[d].append((s, ids[a:b].tobytes()))
    assert {n: b"".join(x for _, x in sorted(got[n])) for n in want} == want


def test_packing_keeps_ids_and_positions_over_16_bits(spark):
    tokens = np.arange(70_000, 139_990, dtype="<u4")
    wide = spark.createDataFrame([(1, tokens.tobytes()), (2, tokens[:5].tobytes())], "id long, ids binary").coalesce(1)
    row, = packing.pack(wide, capacity=70_000, id_bytes=4).collect()
    ids, pos = (np.frombuffer(bytes(x), "<u4") for x in (row.input_ids, row.position_ids))
    assert row.cu_seqlens == [0, 69_990, 69_995] and row.doc_ids == [1, 2]
    assert (ids[:69_995] == np.concatenate([tokens, tokens[:5]])).all() and not ids[69_995:].any()
    assert (pos[:69_990] == np.arange(69_990)).all() and pos[69_990:].tolist() == [0, 1, 2, 3, 4] + [0] * 5


def test_the_encoder_remembers_a_bounded_number_of_chunks(monkeypatch):
    assert bpe.CACHE_CHUNKS <= 250_000      # with a million, four workers of an executor came over 3000 MB
    vocab = bpe.Vocabulary(bpe.vocabulary_path())
    texts = [" ".join(f"word{100 * k + j}" for j in range(100)) for k in range(30)] + ["word1 word2 word1"]
    whole = [x.tolist() for x in bpe.Encoder(vocab, None).encode(texts)]
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 250)
    encoder = bpe.Encoder(vocab, None)
    for text, ids in zip(texts, whole):
        assert encoder.encode([text])[0].tolist() == ids
        assert len(encoder.index) <= 250


def test_packing_holds_the_rests_of_long_documents_only(monkeypatch):
    import tracemalloc
    kept = []
    monkeypatch.setattr(packing, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 0})())}))
    batch = lambda k: pa.RecordBatch.from_arrays(
        [pa.array([k]), pa.array([np.arange(100_001, dtype="<u4").tobytes()], pa.binary())], ["id", "ids"])

    def batches():
        for k in range(50):
            yield batch(k)
            kept.append(tracemalloc.get_traced_memory()[0])
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in packing._pack(100, 0, 4_000_000, 4, pa.int64())(batches()))
    finally:
        tracemalloc.stop()
    assert rows == 50 * 1000 + 1            # the 50 rests of one token share a row
    assert kept[-1] - kept[5] < 5_000_000   # 45 documents of 400 kB, each with a rest of one token


@pytest.mark.parametrize("length", [7, 10, 25])
def test_windows_of_many_rows_hold_every_segment_once(monkeypatch, length):
    monkeypatch.setattr(packing, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 0})())}))
    n = 5 * packing.EMIT_ROWS + 3
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([np.arange(length, dtype="<u4").tobytes()] * n, pa.binary())], ["id", "ids"])
    rows = [r for b in packing._pack(10, 0, 4_000_000, 4, pa.int64())(iter([batch])) for r in b.to_pylist()]
    segments = [(d, s) for r in rows for d, s in zip(r["doc_ids"], r["doc_starts"])]
    assert sorted(segments) == [(d, s) for d in range(n) for s in range(0, length, 10)]
    assert [r["pack_id"] for r in rows] == list(range(len(rows)))


def test_packing_query_packs_token_ids(spark):
    from hearth.llm import QUERIES
    used = sum(r.cu_seqlens[-1] for r in QUERIES["op6_best_fit_packing"](spark, SF0001).select("cu_seqlens").collect())
    tokens = QUERIES["op3_bpe_round_trip"](spark, SF0001).agg(F.sum("n_tokens")).first()[0]
    assert used == tokens


# ---------------------------------------------------------------- 7: lines

def test_line_edges(awkward, empty):
    rows = line_dedup(awkward).select("row.n", "n_lines", "n_dropped", "kept_text").collect()
    got = {r.n: (r.n_lines, r.n_dropped, r.kept_text) for r in rows}
    assert len(got) == len(AWKWARD)
    # the key is in documents 7, 8 and 9: all lose it but the last
    assert got[9] == (3, 2, "short") and got[10] == (2, 1, "other") and got[11] == (2, 0, AWKWARD[11][1])
    assert got[3] == got[4] == (1, 0, "") and got[0][1] == got[1][1] == got[2][1] == 0      # two documents only
    assert line_dedup(empty).count() == 0


# ---------------------------------------------------------------- 8: exact copies

def slow_groups(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append((i is None, i, k))
    return groups


@pytest.mark.parametrize("chars", [64, 1])
def test_exact_copies(awkward, empty, chars):
    rows = exact_dedup(awkward, digest_chars=chars).select("row.n", "keep_id", "group_size", "kept", "text_sha256").collect()
    got = {r.n: r for r in rows}
    assert len(rows) == len(got) == len(AWKWARD)
    for norm, members in slow_groups(AWKWARD).items():
        keep = min(members, key=lambda m: (m[0], m[1] or 0))
        assert sum(got[k].kept for _, _, k in members) == 1
        for _, i, k in members:
            assert (got[k].keep_id, got[k].group_size, got[k].text_sha256) == (keep[1], len(members), sha(norm))
    kept = drop_exact_copies(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(slow_groups(AWKWARD))
    assert exact_dedup(empty).count() == 0


# ---------------------------------------------------------------- 9: neighbours

def test_neighbours_recall_and_scores(spark):
    folder = SF0001.replace("0.001", "0.1")
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    e = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet' ORDER BY vec_id").fetchnumpy()
    x, hit, total = np.stack(e["embedding"]).astype(float), 0, 0
    found = defaultdict(list)
    for r in ann.nearest(df).collect():
        found[r.query_id].append(r)
    assert set(found) == {int(i) for i in e["vec_id"] if i % 20 == 0}
    for q, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        s = x @ x[q]
        s[q] = -9
        true = set(np.argsort(-s, kind="stable")[:20].tolist())
        hit += len(true & {r.vec_id for r in rows})
        total += 20
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all(abs(s[r.vec_id] - r.score) < 1e-12 for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
    assert hit / total >= 0.95


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in ann.nearest(df, probes=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got == {0: [(1, 1.0), (2, 1.0), (20, 1.0), (3, 0.0)], 20: [(0, 1.0), (1, 1.0), (2, 1.0), (3, 0.0)]}
    assert ann.nearest(df.limit(0)).count() == 0
    many = spark.createDataFrame([(k, [1.0, 0.0]) for k in range(100)], "vec_id long, embedding array<double>")
    out = ann.nearest(many).filter("query_id = 40").orderBy("rank").collect()
    assert [r.vec_id for r in out] == list(range(20))


def listed(df, **options):
    got = defaultdict(list)
    for r in ann.nearest(df, **options).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    return got


def vectors(spark, x):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("rows,axes", [(15, 1), (300, 2)])
def test_lists_are_full_where_cells_hold_too_few(spark, rows, axes):
    x = np.random.default_rng(3).normal(size=(rows, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = listed(vectors(spark, x), axes=axes)
    assert set(got) == set(range(0, rows, 20))
    for q, ids in got.items():
        assert len(ids) == min(20, rows - 1)
        if rows < 20:
            assert ids == [k for k in np.argsort(-(x @ x[q])).tolist() if k != q]


def test_neighbours_of_skewed_length(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x *= (rng.lognormal(0, 1, 3000) / np.linalg.norm(x, axis=1))[:, None]
    hit = 0
    for q, ids in listed(vectors(spark, x)).items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(ids) & set(np.argsort(-s)[:20].tolist()))
    assert hit / (150 * 20) >= 0.99


def test_groups_of_a_hot_direction_are_bounded(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 64))
    x[:400] = x[0] + 0.001 * rng.normal(size=(400, 64))
    score, folder = ann._score, str(tmp_path)

    def watched(top):
        run = score(top)

        def noted(key, left, right):
            name = hashlib.sha256(repr(key).encode()).hexdigest()
            with open(f"{folder}/{name}", "w") as f:
                f.write(f"{left.num_rows} {right.num_rows}")
            return run(key, left, right)
        return noted
    monkeypatch.setattr(ann, "BLOCK", 32)
    monkeypatch.setattr(ann, "_score", watched)
    got = listed(vectors(spark, x), every=2)
    sizes = [tuple(map(int, p.read_text().split())) for p in tmp_path.iterdir()]
    assert max(a for a, _ in sizes) <= 64 and max(b for _, b in sizes) <= 64   # dealt by hash: about 32
    for q in range(0, 400, 40):
        s = x @ x[q]
        s[q] = -np.inf
        assert got[q] == np.argsort(-s)[:20].tolist()


# ---------------------------------------------------------------- 10: near copies

def slow_links(rows, threshold=0.8, n=5):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9]
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    count = dict.fromkeys(sets, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: (find(i), count[i]) for i in sets}


def near(df, **options):
    return {r.id: (r.class_id, r.n_links) for r in near_dup.near_duplicates(df, **options).collect()}


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.9995):
        b, r = near_dup.bands_for(0.8, recall)
        assert 1 - (1 - 0.8 ** r) ** b >= recall and b * r <= 128


def test_links_match_brute_force(docs, texts):
    assert near(docs) == slow_links(texts.items())


def test_links_of_a_chain_and_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)       # several blocks
    r = random.Random(2)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):      # copies of one text with growing changes
        w = list(words)
        for _ in range(r.randrange(4)):
            w[r.randrange(120)] = f"x{r.randrange(1000)}"
        rows.append((k, " ".join(w)))
    for k in range(60, 90):     # a chain: each differs a little from the one before
        words = words[3:] + [f"c{k}{j}" for j in range(3)]
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near(df) == slow_links(rows)


def test_a_repeated_id_speaks_with_one_of_its_texts(spark):
    """Signature and comparison must use the same text of an id with several."""
    r = random.Random(8)
    for trial in range(2):
        a, b, c = ([f"{x}{trial}{k}" for k in range(100)] for x in "abc")
        near_a, near_b = (" ".join([*w[:99], "changed"]) for w in (a, b))
        rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near_a), (3, near_b), (4, " ".join(c))]
        r.shuffle(rows)
        got = near(spark.createDataFrame(rows, "doc_id long, text string"))
        either = [slow_links([(1, " ".join(w)), (2, near_a), (3, near_b), (4, " ".join(c))]) for w in (a, b)]
        assert got in either


def test_only_the_copy_of_a_repeated_id_goes(spark):
    for trial in range(2):
        a, b, c = ([f"{x}{trial}{k}" for k in range(100)] for x in "abc")
        near_a = " ".join([*a[:99], "changed"])
        rows = [(1, " ".join(a), 0), (2, near_a, 1), (2, " ".join(b), 2), (2, " ".join(b), 3), (None, near_a, 4),
                (3, " ".join(c), 5), (3, " ".join([*c[:99], "other"]), 6), (3, None, 7), (4, "", 8)]
        df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
        kept = sorted(x.n for x in near_dup.drop_near_copies(df).collect())
        # of the two near texts under id 3, one stays
        assert [k for k in kept if k not in (5, 6)] == [0, 2, 3, 4, 7, 8] and len(kept) == 7


def test_near_edges(awkward, empty):
    got = near(awkward)
    assert got[1] == (1, 1) and got[2] == (1, 1) and got[3] == (3, 0) and got[4] == (4, 0) and got[5] == (5, 0)
    assert None not in got and len(got) == 10
    kept = near_dup.drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.n for r in kept.select("n").collect()) == [0, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert near(empty) == {} and near_dup.drop_near_copies(empty).count() == 0
