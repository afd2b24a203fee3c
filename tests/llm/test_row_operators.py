"""Token counts, byte-level BPE, secrets, pseudonyms and contamination against brute force and round trips."""

from __future__ import annotations

import base64
import datetime
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken

from skerry.llm import byte_bpe, decontaminate, pii, secret_scan, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, n_tokens int, hit string"


def docs(spark, *texts):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], SCHEMA)


def noise(seed: int, size: int, alphabet: list[str]) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(size))


MIXED = ["a", "the", "ing", " ", " ", "\n", "\t", "\x0b", "\x85", "\xa0", "　", "́", "İ", "Σ", "7", "'s", "'", "!", "日本", "é", "<|endoftext|>", "<|startoftext|>", "\x1c"]


@pytest.fixture(scope="module")
def tokenizer():
    return token_counts.load_tokenizer(WORDS)


@pytest.fixture(scope="module")
def reference():
    lines = open(RANKS, "rb").read().split(b"\n")
    ranks = {base64.b64decode(x.split()[0]): int(x.split()[1]) for x in lines if x.strip()}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)


class TestTokenCounts:
    def test_pieces_equal_whole_texts(self, tokenizer):
        count = token_counts.text_counter(WORDS)
        texts = [noise(s, 200, MIXED) for s in range(300)]
        assert count(texts) == [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]

    @pytest.mark.parametrize("seed", range(12))
    def test_chunks_equal_whole_texts(self, tokenizer, seed):
        text = noise(seed, 1500, MIXED)
        whole = len(tokenizer.encode(text, add_special_tokens=False))
        assert token_counts.count_resynchronised(tokenizer, text, 200, 20) == whole

    def test_overlap_widens(self, tokenizer):
        text = "x" * 900 + " end " + "word " * 50 + "y" * 700
        widened: list[int] = []
        got = token_counts.count_resynchronised(tokenizer, text, 100, 10, widened)
        assert got == len(tokenizer.encode(text, add_special_tokens=False))
        assert widened

    def test_splitters_that_reach_over_white_space(self, spark, tokenizer):
        assert token_counts.cuts_hold(tokenizer)
        other = public_tokenizers.path("byte_bpe_50k.json")
        library = token_counts.load_tokenizer(other)
        assert not token_counts.cuts_hold(library)
        texts = [noise(s, 80, MIXED + ["  ", "\n"]) for s in range(30)] + ["", " a  b", "word " * 9000]
        rows = token_counts.count_tokens(docs(spark, *texts), other).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in rows} == {
            i: len(library.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)
        }

    def test_rows(self, spark):
        got = token_counts.count_tokens(docs(spark, None, "", "two words", "two words", "a " * 3000), WORDS, limit=2048)
        rows = sorted(map(tuple, got.collect()))
        assert rows == [(0, 0, 0, False), (1, 0, 0, False), (2, 9, 2, False), (3, 9, 2, False), (4, 6000, 3000, True)]
        assert token_counts.count_tokens(docs(spark).limit(0), WORDS).count() == 0


class TestByteBpe:
    def test_equals_the_rank_library(self, codec, reference, monkeypatch):
        texts = [noise(s, 120, MIXED + ["  ", "   ", "\r\n", "aaaa", "====", "😀"]) for s in range(2000)]
        texts += ["a" * n for n in range(1, 80)] + [" " * n + "x" for n in range(1, 40)] + ["\n" * n for n in range(1, 30)]
        assert codec.encode_batch(texts) == [reference.encode_ordinary(t) for t in texts]
        pieces = byte_bpe.Pieces(codec)
        assert [pieces.encode(t) for t in texts] == codec.encode_batch(texts)
        monkeypatch.setattr(byte_bpe, "MEMO_PIECES", 500)
        monkeypatch.setattr(byte_bpe, "CHAIN_PIECES", 7)
        forgetful = byte_bpe.Pieces(codec)
        for start in range(0, len(texts), 50):
            part = texts[start : start + 50]
            for text, own in zip(part, forgetful.split(part)):
                assert b"".join(forgetful.decoded[p] for p in own) == text.encode()
                assert ",".join(forgetful.listed[p] for p in own) == ",".join(map(str, reference.encode_ordinary(text)))

    def test_every_character(self, codec, reference):
        texts = [f"a{chr(c)} {chr(c)}1" for c in range(0, 0x30000) if not 0xD800 <= c <= 0xDFFF]
        pieces = byte_bpe.Pieces(codec)
        pieces.split(texts)
        assert [pieces.encode(t) for t in texts] == [reference.encode_ordinary(t) for t in texts]

    def test_split_characters(self, codec):
        text = "x 😀 日本é"
        found = codec.encode_with_offsets(text)
        assert [f[1] for f in found[1:]] == [f[2] for f in found[:-1]] and found[-1][2] == len(text.encode())
        assert all(codec.bytes_of[i] == text.encode()[a:b] for i, a, b, _, _ in found)
        ids = [f[0] for f in found]
        assert codec.decode(ids) == text
        assert any(codec.decode([i]) == "�" * len(codec.decode([i])) for i in ids)

    def test_offsets_of_rows(self, spark, codec):
        texts = [None, "", "x 😀 日本é", *(noise(s, 60, MIXED + ["😀", "漢"]) for s in range(40))]
        rows = byte_bpe.round_trip(docs(spark, *texts), RANKS, public_tokenizers.PATTERN, keep_offsets=True).collect()
        assert len(rows) == len(texts)
        for row in rows:
            text = texts[row["doc_id"]] or ""
            found = [tuple(o) for o in row["offsets"]]
            assert found == codec.encode_with_offsets(text)
            assert row["decoded_sha256"] == hashlib.sha256(codec.decode_bytes([f[0] for f in found])).hexdigest()
            assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()

    def test_rows(self, spark, reference):
        got = byte_bpe.round_trip(docs(spark, None, "", "Hi  there", "Hi  there"), RANKS, public_tokenizers.PATTERN, keep_ids=True)
        rows = sorted(map(tuple, got.collect()))
        nothing = hashlib.sha256(b"").hexdigest()
        ids = reference.encode_ordinary("Hi  there")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[0] == (0, 0, nothing, nothing, []) and rows[1][1:] == (0, nothing, nothing, [])
        assert rows[2][1:] == rows[3][1:] == (len(ids), listed, hashlib.sha256(b"Hi  there").hexdigest(), ids)


class TestSecrets:
    def test_windows_equal_direct_entropy(self):
        import math
        from collections import Counter

        text = noise(3, 300, list("abcdef0123456789aaaa"))
        hot = set()
        for i in range(len(text) - 19):
            part = Counter(text[i : i + 20]).values()
            if -sum(c / 20 * math.log2(c / 20) for c in part) >= 3.0 - 1e-9:
                hot |= set(range(i, i + 20))
        spans = secret_scan.hot_windows(text, 20, 3.0)
        assert {p for a, b in spans for p in range(a, b)} == hot

    def test_spans_equal_brute_force(self):
        """Every window of every class on its own, without running counts."""
        import math
        import re
        from collections import Counter

        rng = random.Random(9)
        rules = [re.compile(r) for r in secret_scan.ALLOWED]
        candidates = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
        alphabets = ["abcdef0123456789", "abcXYZ0189", "ab+/=_-XY12", "abcdefgh", "=/"]
        for _ in range(150):
            text = " ".join("".join(noise(rng.random(), rng.randint(5, 40), list(rng.choice(alphabets)))
                                    for _ in range(rng.randint(1, 4))) for _ in range(3))
            want = []
            for match in candidates.finditer(text):
                word, hot = match[0], set()
                for _, alphabet, threshold in secret_scan.CLASSES:
                    for run in alphabet.finditer(word):
                        if alphabet is not secret_scan.CLASSES[-1][1] and any(r.fullmatch(run[0]) for r in rules):
                            continue
                        # A run that a narrower class has searched is left to it.
                        narrower = secret_scan.CLASSES[: [c[1] for c in secret_scan.CLASSES].index(alphabet)]
                        if len(run[0]) < 20 or any(m.span() == run.span() for c in narrower for m in c[1].finditer(word)):
                            continue
                        for at in range(run.start(), run.end() - 19):
                            share = Counter(word[at : at + 20]).values()
                            if -sum(c / 20 * math.log2(c / 20) for c in share) < threshold - 1e-9:
                                continue
                            if alphabet is secret_scan.CLASSES[-1][1]:
                                tokens = [t.span() for t in secret_scan.TOKEN.finditer(word) if t.end() > at and t.start() < at + 20]
                                if any(r.fullmatch(word[tokens[0][0] : tokens[-1][1]]) for r in rules):
                                    continue
                            hot.add(at)
                places = {p for at in hot for p in range(at, at + 20)}
                joined = [p for p in sorted(places) if p - 1 not in places]
                for start in joined:
                    end = start
                    while end in places:
                        end += 1
                    # Windows that only touch are one span too.
                    kind = next(n for n, a, _ in secret_scan.CLASSES if a.fullmatch(word[start:end]))
                    want.append((match.start() + start, match.start() + end, kind))
            assert secret_scan.entropy_spans(text, candidates, rules) == want

    def test_memory_of_a_long_run_is_bounded(self):
        import base64
        import re
        import tracemalloc

        text = "data:" + base64.b64encode(random.Random(1).randbytes(240_000)).decode()
        rules = [re.compile(r) for r in secret_scan.ALLOWED]
        tracemalloc.start()
        found = secret_scan.entropy_spans(text, re.compile(r"[A-Za-z0-9+/_=-]{20,}"), rules)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found and peak < 13_000_000  # 320,000 characters

    def test_rows(self, spark):
        secret = "0a1b2c3d4e5f60718293a4b5c6d7e8f9"
        texts = [
            None,
            "",
            f'token = "{secret}" and AKIA{"A" * 12} Password: short, API-key',
            "id 123e4567-e89b-42d3-a456-426614174000 at src/main/python/package/module",
            "blob q8Zr+T5yWb/2KxLm9vNc=end EXAMPLEq8ZrT5yWb2KxLm9vNc",
            f"ſecret={secret[:12]} paſſword:abcdefghij é SECRET={secret[:12]}",
        ]
        rows = {r["doc_id"]: r for r in secret_scan.scan_secrets(docs(spark, *texts)).collect()}
        assert rows[0]["spans"] == rows[1]["spans"] == rows[3]["spans"] == ""
        assert (rows[2]["n_assign"], rows[2]["n_access"], rows[2]["n_hex"]) == (1, 1, 1)
        base = f"assign:0:41,hex:9:41,access:47:63"
        assert rows[2]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert "entropy_hex:9:41" in rows[2]["spans"]
        assert rows[4]["n_entropy"] == 1 and rows[4]["spans"].startswith("entropy_base64:5:")
        assert rows[5]["n_assign"] == 1

    def test_keys_joined_to_other_characters(self):
        rules = [re.compile(rule) for rule in secret_scan.ALLOWED]
        candidates = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
        for seed, (before, after) in enumerate([("id=", ""), ("/v1/", "/get"), ("a_", "-b"), ("/example/dir=", ""), ("path/sample/", "")] * 40):
            for alphabet, size in (("0123456789ABCDEF", 32), ("0123456789abcdef", 28)):
                key = noise(seed, size, list(alphabet))
                alone = secret_scan.entropy_spans(key, candidates, rules)
                glued = secret_scan.entropy_spans(before + key + after, candidates, rules)
                place = {p + len(before) for a, b, _ in alone for p in range(a, b)}
                assert place and place <= {p for a, b, _ in glued for p in range(a, b)}
        for text in ("src/main/python/package/module", "v=EXAMPLEq8ZrT5yWb2KxLm9vNc", "123e4567-e89b-42d3-a456-426614174000"):
            assert secret_scan.entropy_spans(text, candidates, rules) == []


class TestPii:
    def test_permutation(self):
        feistel = pii.Feistel(b"k")
        for size in (1, 2, 10, 37, 1000):
            image = [feistel.permute(i, "t", size) for i in range(size)]
            assert sorted(image) == list(range(size))
            assert [feistel.permute(i, "t", size, back=True) for i in image] == list(range(size))

    def test_formats_and_links(self, spark):
        texts = [
            "card 4111 1111 1111 1111 and 4111111111111111, not 4111111111111112 or 0.4111111111111111",
            "on 2024-02-29, 29/02/2024, not 2023-02-29; 01.02.2003 and 05/13/1999",
            "mail jo.smith7@mail7.example.com ip 97.51.17.173 not 999.1.1.1 v1.2.3",
            "call +1 (017) 555-7713 or 555-123-4567; GB82 WEST 1234 5698 7654 32",
            None,
            "",
            "again 4111111111111111 from jo.smith7@mail7.example.com",
        ]
        frame = docs(spark, *texts)
        rows = {r["doc_id"]: r for r in pii.pseudonymise(frame, "key").collect()}
        cards = re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}", rows[0]["text"])
        assert rows[0]["n_card"] == 2 and cards[0].replace(" ", "") == cards[1] != "4111111111111111"
        assert pii.luhn_digit(cards[1][:-1]) == cards[1][-1] and "4111111111111112" in rows[0]["text"]
        assert cards[1] in rows[6]["text"]
        dates = re.findall(r"\d+[-/.]\d+[-/.]\d+", rows[1]["text"])
        assert rows[1]["n_date"] == 4 and datetime.date.fromisoformat(dates[0]) and "2023-02-29" in rows[1]["text"]
        assert (rows[2]["n_email"], rows[2]["n_ipv4"]) == (1, 1)
        mail = re.search(r"[a-z]{2}\.[a-z]{5}\d@[a-z]{4}\d\.example\.com", rows[2]["text"])[0]
        assert mail in rows[6]["text"] and "97.51.17.173" not in rows[2]["text"]
        assert (rows[3]["n_phone"], rows[3]["n_iban"]) == (2, 1) and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", rows[3]["text"])
        assert rows[4]["text"] == rows[5]["text"] == ""
        back = pii.pseudonymise(pii.pseudonymise(frame, "key").drop("spans"), "key", back=True)
        assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}

    @pytest.mark.parametrize(
        "text,values",
        [
            ("DE89370400440532013000 BIC COBADEFF", ["DE89370400440532013000"]),
            ("DE89 3704 0044 0532 0130 00 12", ["DE89 3704 0044 0532 0130 00"]),
            ("GB82WEST12345698765432 USD 100", ["GB82WEST12345698765432"]),
            ("AB12 CDEF DE89370400440532013000 DE89 3704 0044 0532 0130 00 END", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"]),
            ("call +14155550123, or (+33612345678)", ["+14155550123", "+33612345678"]),
            ("tel 06 12 34 56 78 or 06.12.34.56.79, +33 6 12 34 56 78", ["06 12 34 56 78", "06.12.34.56.79", "+33 6 12 34 56 78"]),
            ("not 12+34567890 or 10 20 30 or DE00370400440532013000 BIC", []),
        ],
    )
    def test_values_before_other_words(self, text, values):
        feistel = pii.Feistel(b"k")
        found = pii.find_private(text, feistel)
        assert [text[a:b] for a, b, _, _ in found] == values
        masked = pii._replaced(text, found)
        assert not any(v in masked for v in values)
        assert pii._replaced(masked, pii.find_private(masked, feistel, back=True)) == text

    def test_phone_forms_share_pseudonyms_and_come_back(self):
        rng = random.Random(2)
        feistel = pii.Feistel(b"k")
        for _ in range(300):
            code = rng.choice(["1", "33", "49", "44", "971", "7"])
            number = code + "".join(rng.choice("0123456789") for _ in range(rng.randint(8, 15) - len(code)))
            text = f"+{number} 0{rng.randint(0, 9)} " + " ".join(f"{rng.randint(0, 99):02d}" for _ in range(4))
            found = pii.find_private(text, feistel)
            assert [k for _, _, k, _ in found] == ["phone", "phone"] and found[0][3].startswith(f"+{code}")
            masked = pii._replaced(text, found)
            assert pii._replaced(masked, pii.find_private(masked, feistel, back=True)) == text


    def test_long_lists_of_values_take_no_square(self):
        import time

        text = "".join(f"me{i}@host{i % 7}.example.org 2021-0{1 + i % 9}-1{i % 10}\n" for i in range(30_000))
        feistel, start = pii.Feistel(b"k"), time.monotonic()
        found = pii.find_private(text, feistel)
        assert len(found) == 60_000 and len(text) > 900_000 and time.monotonic() - start < 60
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))

    def test_social_numbers_are_validated_and_stay_valid(self):
        feistel = pii.Feistel(b"k")
        rejected = "000-12-3456 666-12-3456 900-12-3456 999-99-9999 123-00-4567 123-45-0000"
        assert pii.find_private(rejected, feistel) == []
        rng, seen = random.Random(5), set()
        for _ in range(500):
            text = f"{rng.choice(pii.AREAS):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}"
            ((_, _, kind, new),) = pii.find_private(text, feistel)
            assert kind == "ssn" and pii.find_private(new, feistel, back=True)[0][3] == text
            seen.add(new)
        assert len(seen) >= 499


class TestDecontaminate:
    ITEMS = [
        (1, "a b c d e f g h i j k l"),
        (2, "short one"),
        (3, "X y c d e f g h i j k l"),
        (4, "..."),
        (5, None),
        (6, "a a a a a a a a a a a"),
        (7, "short one"),
    ]

    def brute(self, text, items, window):
        words = [w for w in decontaminate.words_of(text) if w]
        covered, found = set(), set()
        for item, body in items:
            own = [w for w in decontaminate.words_of(body) if w]
            size = min(window, len(own))
            if not own:
                continue
            wins = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in wins:
                    covered |= set(range(i, i + size))
                    found.add(item)
        return len(words), len(covered), sorted(found)

    @pytest.mark.parametrize("block_words", [10**6, 20])
    def test_against_brute_force(self, spark, block_words):
        rng = random.Random(4)
        texts = [" ".join(rng.choice("abcdefghijkl") for _ in range(60)) for _ in range(20)]
        texts += ["z A B,c d e f g h i J. k l m", "a " * 30, "the short one, short", None, "", "a b c d e f g h i x", "short one"]
        texts += [texts[20]]
        items = self.ITEMS + [(10 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))) for i in range(8)]
        bench = spark.createDataFrame(items, "item_id long, text string")
        for window in (10, 3):
            rows = decontaminate.find_contamination(docs(spark, *texts), bench, window, block_words).collect()
            assert len(rows) == len(texts)
            for row in rows:
                n, hit, found = self.brute(texts[row["doc_id"]], items, window)
                assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, hit, len(found)), row
                assert row["items_sha256"] == decontaminate.items_digest(found)
                assert row["contaminated"] == (hit > 0)

    def test_textual_ids(self, spark):
        bench = spark.createDataFrame([("b-10", "one two three"), ("B-9", "one two three"), (None, "two")], "item_id string, text string")
        (row,) = decontaminate.find_contamination(docs(spark, "x one two three y"), bench).collect()
        assert row["n_items"] == 2 and row["items_sha256"] == decontaminate.items_digest(["b-10", "B-9"]) and row["n_hit"] == 3

    def test_one_automaton_per_worker(self):
        items = [("1", "one two three")]
        first = decontaminate.automaton_of(items, 10)
        assert decontaminate.automaton_of(items, 10) is first and decontaminate.automaton_of(items, 3) is not first
        assert decontaminate.automaton_of([("1", "one two three")], 3) is not first

    def test_removal(self, spark):
        passage = "a b c d e f g h i j k"
        texts = [f"{'clean ' * 30}{passage.upper()}; after", passage, "clean", None, f"{'w ' * 40} a b c d {passage} e f g h i j k"]
        frame = docs(spark, *texts)
        out = decontaminate.remove_contamination(frame, spark.createDataFrame(self.ITEMS, "item_id long, text string"), max_coverage=0.5)
        rows = {r["doc_id"]: r["text"] for r in out.collect()}
        assert set(rows) == {0, 2, 3, 4} and rows[2] == "clean" and rows[3] is None
        assert rows[0] == "clean " * 30 + "; after" and out.columns == frame.columns
        again = decontaminate.find_contamination(out, spark.createDataFrame(self.ITEMS, "item_id long, text string"))
        assert not any(r["contaminated"] for r in again.collect())

    def test_removal_in_blocks_equals_one_block(self, spark):
        """Coverage is judged on the passages of all blocks together, and nothing of any block stays."""
        names = [f"{a}{i}" for a in "pqrstu" for i in range(30)]
        items = [(at, " ".join(names[at * 30 : at * 30 + 30])) for at in range(6)]
        body = [i[1] for i in items]
        plain = lambda n: " ".join(f"w{i}" for i in range(n))
        texts = [f"{body[a]} {plain(40)} {body[b]}" for a in range(6) for b in range(6) if a != b]
        halves = [(" ".join(b.split()[:9]), " ".join(b.split()[9:])) for b in body]
        texts += [f"{plain(90)} {halves[a][0]} {body[b]} {halves[a][1]}" for a in range(6) for b in range(6) if a != b]
        texts += [None, "", plain(5), plain(5)]
        bench = spark.createDataFrame(items, "item_id long, text string")
        assert decontaminate._item_blocks(bench, "item_id", "text", 20)[1] > 1
        frame = docs(spark, *texts)
        got = [
            sorted(map(tuple, decontaminate.remove_contamination(frame, bench, block_words=n, length_col="n_tokens").collect()), key=str)
            for n in (10**6, 20)
        ]
        assert got[0] == got[1] and 4 < len(got[0]) < len(texts)
        out = spark.createDataFrame(got[1], SCHEMA)
        assert not any(r["contaminated"] for r in decontaminate.find_contamination(out, bench).collect())

    def test_empty_tables(self, spark):
        none = spark.createDataFrame([], "item_id long, text string")
        assert [r["n_hit"] for r in decontaminate.find_contamination(docs(spark, "a b"), none).collect()] == [0]
        assert decontaminate.find_contamination(docs(spark).limit(0), none).count() == 0


def contamination(frame):
    items = frame.sparkSession.createDataFrame([(1, "one two three"), (None, "two"), (2, None)], "item_id long, text string")
    return decontaminate.find_contamination(frame, items)


ODD = {
    "tokens": lambda df: token_counts.count_tokens(df, WORDS),
    "secrets": secret_scan.scan_secrets,
    "private": lambda df: pii.pseudonymise(df, "key"),
    "bytes": lambda df: byte_bpe.round_trip(df, RANKS, public_tokenizers.PATTERN),
    "contamination": contamination,
}


@pytest.mark.parametrize("name", list(ODD))
def test_odd_rows(spark, name):
    """NULL ids and texts, repeated rows, a very long text, columns named like results, and no rows at all."""
    long = "one two three 4111111111111111 " * 20_000 + "x" * 70_000
    rows = [(1, "one two three"), (1, "one two three"), (None, "one two three"), (None, None), (2, None), (3, ""), (4, long)]
    names = "n_tokens int, spans int, text_key string, masked int, items int, block int"
    frame = spark.createDataFrame([(i, t, 1, 2, "k", 3, 4, 5) for i, t in rows], f"doc_id long, text string, {names}")
    got = ODD[name](frame.repartition(2)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    same = [tuple(r)[1:] for r in got if r["doc_id"] == 1]
    assert same[0] == same[1] and same[0] in [tuple(r)[1:] for r in got if r["doc_id"] is None]
    assert ODD[name](frame.limit(0)).count() == 0
