"""The operators against brute force, exact round trips and held-out accuracy, with awkward rows throughout."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sondage.llm import bagminhash, fertility, fingerprint, langid, mixing, pii, sentencepieces, urlfilter, warc, wavelet
from sondage.llm.queries import ORACLES, QUERIES, URL_RULES, thin, tokenizer_file
from sondage.llm.shared import utf8

BPE, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def empty(docs):
    return docs.limit(0)


# op1


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_token_index(docs, tokenizer):
    got = wavelet.token_index(docs, BPE).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, want = 0, []
    for k, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    assert wavelet.token_index(empty(docs), BPE).count() == 0


def test_special_tokens_in_texts_are_the_librarys(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    texts = ["end of page <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b", "x\n<|endoftext|>\n y", "  <|endoftext|>  z <|endoftext|>.", "<|endoftext| >"]
    got = wavelet.token_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), BPE).orderBy("doc_id").collect()
    want = [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert 50256 in want[0] and [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in want]


def test_chunks_are_encoded_like_whole_texts(tokenizer):
    cases = ["a   b", " a \n b", "a\n\n b  ", "x\t y's 's <|endoftext|> q", "", "  lead", "tab\t\n x \r\n y", "ünï 中文 🎉 a\x0b b", "\n\n\na \n\n", " ", "\n", "don't.. stop,. A.B,c 12.5", "é.,é"]
    ids, at = wavelet.ChunkIds(BPE).of(*utf8(pa.array(cases)))
    for i, text in enumerate(cases):
        assert ids[at[i] : at[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n, kinds", [(0, 1), (1, 1), (1000, 1), (5000, 37), (3000, 70000)])
def test_wavelet_matrix(n, kinds):
    ids = np.random.default_rng(n).integers(0, kinds, n).astype(np.uint32)
    s = wavelet.Shard(wavelet.build(ids) | {"n_tokens": n})
    assert (s.ids() == ids).all()
    for i in range(0, n, max(1, n // 50)):
        assert s.access(i) == ids[i]
        where = np.flatnonzero(ids == ids[i])
        assert s.count(int(ids[i])) == len(where) and s.count(int(ids[i]), 7, i) == ((where >= 7) & (where < i)).sum()
        assert s.find(int(ids[i]), len(where) // 2) == where[len(where) // 2] and s.find(int(ids[i]), len(where)) == -1
    assert s.count(99999999) == 0


# op2


def test_surrogates(spark):
    texts = [
        "Dear Mrs. Mary Smith, call John Smith or Mr. Smith at 555-123-4567 or (555) 123-4567.", "Write to Ann.Lee@mail.example.com or ann.lee@mail.example.com!", "Иван Петров пишет", "card 4111 1111 1111 1111, 4111111111111111; host 10.1.2.3",
        "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "clean text, version 2.0 of 1999.", None, "", "a" * 5000,
    ]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts + texts[:1])], "doc_id long, text string, kind string")
    got = {r.doc_id: r for r in pii.replaced(df, "key").collect()}
    assert len(got) == len(texts) + 1 and got[len(texts)].text == got[0].text
    m = re.fullmatch(r"Dear Mrs\. (\w+a) (\w+), call (\w+o) (\w+) or Mr\. (\w+) at (\d{3}-\d{3}-\d{4}) or (\(\d{3}\) \d{3}-\d{4})\.", got[0].text)
    assert m and m[2] == m[4] == m[5] and re.sub(r"\D", "", m[6]) == re.sub(r"\D", "", m[7]) != "5551234567" and got[0].n_entities == 5
    a, b = re.fullmatch(r"Write to (\S+@\S+\.example\.\w+) or (\S+)!", got[1].text).groups()
    assert a == b and "ann" not in a
    assert re.fullmatch(r"[Ѐ-ӿ]+ [Ѐ-ӿ]+ пишет", got[2].text) and "Иван" not in got[2].text
    card, same, ip = re.fullmatch(r"card ([\d ]{19}), (\d{16}); host ([\d.]+)", got[3].text).groups()
    digits = [int(c) for c in reversed(same)]
    assert card.replace(" ", "") == same and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert all(0 < int(x) < 256 for x in ip.split(".")) and "04dbebab" not in got[4].text and re.search(r'"[0-9a-f]{40}"', got[4].text)
    assert all(got[i].text == texts[i] and got[i].n_entities == 0 for i in (5, 6, 7, 8)) and got[0].kind == "k"
    assert {r.text for r in pii.replaced(df, "other").collect()} != {r.text for r in got.values()}
    assert pii.replaced(df.limit(0), "key").count() == 0


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def mod97(iban):
    x = re.sub(r"\s", "", iban)
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97


def test_names_domains_and_ibans(spark):
    texts = [
        "Yesterday Anna Lopez met Maria Garcia and Tom Hanks.", "bob@x.com wrote to eve@x.com and bob@y.org", "Pay GB82 WEST 1234 5698 7654 32 or GB83WEST12345698765432.", "my name is Ravi Shankar; Dear Mrs Anna, thanks",
        "Mr. Garcia and Lopez came", "mail a@x.com b@x.com c@x.com",
    ]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_entities int")
    got = {r.doc_id: r.text for r in pii.replaced(df, "key").collect()}
    m = re.fullmatch(r"Yesterday (\w+a) (\w+) met (\w+a) (\w+) and (\w+o) (\w+)\.", got[0])
    assert m and len(set(m.groups())) == 6 and not set(m.groups()) & {"Anna", "Lopez", "Maria", "Garcia", "Tom", "Hanks"}
    assert got[4] == f"Mr. {m[4]} and Lopez came"  # a surname alone is no mention
    one, two, three = re.fullmatch(r"(\S+) wrote to (\S+) and (\S+)", got[1]).groups()
    domain = lambda a: a.split("@")[1]
    assert domain(one) == domain(two) != domain(three) and one != two and domain(got[5].split(" ")[1]) == domain(one)
    assert len({a for a in got[5].split(" ")[1:]}) == 3
    right, wrong = re.fullmatch(r"Pay (GB\d\d [A-Z]{4}(?: \d{4}){3} \d\d) or (GB\d\d[A-Z]{4}\d{14})\.", got[2]).groups()
    assert mod97(right) == 1 != mod97(wrong)
    assert re.fullmatch(r"my name is \w+ \w+; Dear Mrs (\w+), thanks", got[3]) and "Ravi" not in got[3] and m[1] in got[3]
    assert {r.n_entities for r in pii.replaced(df, "key").collect()} == {7}  # a column of the count's name keeps its values
    assert pii.replaced(df.drop("n_entities"), "key", count=None).columns == ["doc_id", "text"]


def test_names_again_in_their_text(spark):
    """Later mentions of a text's surnames: bare, possessive, with initials, in capitals; hyphens, IPv6, versions; none in other texts."""
    texts = [
        "John A. Smith came. Smith's wife Jane Smith saw JOHN SMITH, J. Smith and the smith; Smithson and Smith-Jones left.", "Smith alone, and the version 1.2.3.4 of it.", "Jean-Pierre Dupont and Dr. O'Brien met Mrs. MacDonald; O'BRIEN, DUPONT.",
        "host 2001:db8:0:1::7 or 2001:DB8:0:1::7 at 12:30:45, std::dec", "Mr. Müller; MÜLLER, Müller's.", "Anna Lopez-Garcia, LOPEZ-GARCIA", "Mr. J. R. Reed and Reed",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replaced(df, "key").collect()}
    m = re.fullmatch(r"(\w+o) ([A-Z])\. (\w+) came\. (\w+)'s wife Jane (\w+) saw ([A-Z]+) ([A-Z]+), [A-Z]\. (\w+) and the smith; Smithson and Smith-Jones left\.", got[0].text)
    assert m and m[3] == m[4] == m[5] == m[8] and m[7] == m[3].upper() and m[6] == m[1].upper() and "Smith" not in m.groups() and got[0].n_entities == 5
    assert got[1].text == texts[1] and got[1].n_entities == 0
    m = re.fullmatch(r"(\w+o) (\w+) and Dr\. (\w+) met Mrs\. (\w+); ([A-Z]+), ([A-Z]+)\.", got[2].text)
    assert m and m[5] == m[3].upper() and m[6] == m[2].upper() and not re.search("(?i)jean|pierre|dupont|brien|donald", got[2].text)
    one, two = re.fullmatch(r"host (\S+) or (\S+) at 12:30:45, std::dec", got[3].text).groups()
    assert one == two and re.fullmatch(r"[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]:[0-9a-f]::[0-9a-f]", one) and one != "2001:db8:0:1::7"
    m = re.fullmatch(r"Mr\. (\w+); ([A-Z]+), (\w+)'s\.", got[4].text)
    assert m and m[1] == m[3] and m[2] == m[1].upper() and "ller" not in got[4].text
    m = re.fullmatch(r"(\w+a) (\w+), ([A-Z]+)", got[5].text)
    assert m and m[3] == m[2].upper()
    m = re.fullmatch(r"Mr\. [A-Z]\. [A-Z]\. (\w+) and (\w+)", got[6].text)
    assert m and m[1] == m[2] != "Reed"


def test_short_spaces_outgrow_their_entities(spark):
    boxes = spark.range(200).selectExpr("'mailbox@x.com' AS type", "CASE WHEN id < 26 THEN chr(97 + id) ELSE concat(chr(97 + id % 26), chr(97 + id div 26)) END AS value")
    domains = spark.range(26).selectExpr("'domain' AS type", "concat(chr(97 + id), '.com') AS value")
    phones = spark.range(900).selectExpr("'phone' AS type", "concat('1', lpad(id, 3, '0')) AS value")  # nine tenths of all numbers of this shape are taken
    df = boxes.unionByName(domains).unionByName(phones)
    out = pii.surrogates(df, "key").collect()
    assert len(out) == df.count() == len({(r.type, r.surrogate) for r in out})
    assert not {(r.type, r.surrogate) for r in out} & {(r.type, r.value) for r in df.collect()}


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_replacement_against_brute_force(spark):
    """All documents: texts change at their mentions alone, entities and surrogates match one to one, and none is real."""
    import regex

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    after = {r.doc_id: r for r in pii.replaced(docs, "key").collect()}
    assert len(after) == docs.count()
    java = lambda p: p.replace(r"\p{IsCyrillic}", r"\p{Cyrillic}")
    mention = regex.compile(java(pii.MENTION))
    forward, back, real = {}, {}, set()
    for r in docs.collect():
        text, new = r.text or "", after[r.doc_id].text or ""
        found = list(mention.finditer(text))
        assert after[r.doc_id].n_entities == len(found)
        at, begin = 0, 0
        for i, f in enumerate(found):
            kept = text[begin : f.start()]
            assert new[at:].startswith(kept)
            at += len(kept)
            after_it = text[f.end() : found[i + 1].start()] if i + 1 < len(found) else text[f.end() :]
            end = new.index(after_it, at) if after_it else (at + len(f[0]) if i + 1 < len(found) else len(new))
            shown, old = new[at:end], f[0]
            at, begin = end, f.end()
            kind = next((k for k, p in pii.PATTERNS.items() if regex.fullmatch(java(p), old)), "name")
            if kind in ("phone", "card", "ssn", "iban"):
                pairs = [(kind, regex.sub(r"[^0-9A-Z]" if kind == "iban" else r"\D", "", old), regex.sub(r"[^0-9A-Z]" if kind == "iban" else r"\D", "", shown))]
                assert regex.sub(r"[0-9A-Z]", "", shown) == regex.sub(r"[0-9A-Z]", "", old)
                assert kind != "card" or (luhn(pairs[0][1]) == 0) == (luhn(pairs[0][2]) == 0)
                assert kind != "iban" or (mod97(old) == 1) == (mod97(shown) == 1)
            elif kind == "email":
                (a, b), (c, d) = old.lower().split("@"), shown.split("@")
                pairs = [("domain", b, d), ("mailbox@" + b, a, c)]
            elif kind == "name":
                tokens, others = old.split(" "), shown.split(" ")
                assert len(tokens) == len(others)
                lead = tokens[0].rstrip(".") in {t for g in pii.TITLES.values() for t in g}
                assert not lead or tokens[0] == others[0]
                own, new_ = tokens[lead:], others[lead:]
                given = len(own) == 2 or own[0] in {n for g in pii.GIVEN.values() for n in g}
                pairs = [("surname", own[-1], new_[-1])] if not given else [(("given", tokens[0] if lead else ""), own[0], new_[0])][:0] + ([("surname", own[1], new_[1])] if len(own) == 2 else [])
            else:
                pairs = [(kind, old, shown)]
            for k, old_, new_ in pairs:
                assert forward.setdefault((k, old_), new_) == new_ and back.setdefault((k, new_), old_) == old_
                real.add((k, old_))
        assert new[at:] == text[begin:]
    assert len(real) > 20 and not real & set(back)


def test_surrogates_stay_distinct(spark):
    df = spark.range(30_000).selectExpr("'ip' AS type", "concat('10.', id div 60000, '.', id div 250, '.', id % 250) AS value")
    out = pii.surrogates(df, "key")
    assert out.count() == 30_000 == out.select("surrogate").distinct().count() and out.join(df.select(F.col("value").alias("surrogate")), "surrogate").count() == 0


def test_surrogates_of_more_names_than_four_syllables_make(spark):
    df = spark.range(170_000).selectExpr("'surname_latin' AS type", "concat('Q', id) AS value")
    out = pii.surrogates(df, "key").cache()
    assert out.count() == 170_000 == out.select("surrogate").distinct().count() and out.where(r"surrogate rlike '^\\p{Lu}\\p{Ll}+$'").count() == 170_000
    few = spark.createDataFrame([("surname_greek", "Παππάς"), ("given_f_latin", "Mary")], "type string, value string")
    want = pii.drawn(few.withColumn("attempt", F.lit(0)), "key").drop("attempt")
    assert set(pii.surrogates(few, "key").collect()) == set(want.select("type", "value", "surrogate").collect())


# op3


def test_fingerprints(docs, texts):
    got = [r for r in fingerprint.compared(docs).collect()]
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter()
    for i, (k, t) in enumerate(rows):
        h, nxt = len(t) // 2, rows[(i + 1) % len(rows)][1]
        want[(k, len(t), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[1].fingerprint != by[2].fingerprint and by[0].near_next == 1.0
    assert 0.3 < by[1].near_next < 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.compared(empty(docs)).count() == 0


def test_multiset_hash(spark):
    df = spark.createDataFrame([("a\nb\n\nc\na", "c\na\na\nb", "a", "b\nc\na", "")], "x string, y string, z string, rest string, blank string")
    x, y, z, rest, blank = (fingerprint.lanes(F.col(c)) for c in df.columns)
    r = df.select(x == y, x == z, fingerprint.remove(x, z) == rest, fingerprint.add(rest, z) == x, fingerprint.likeness(x, y), fingerprint.likeness(x, blank), fingerprint.likeness(blank, blank)).first()
    assert list(r) == [True, False, True, True, 1.0, 0.0, 1.0]


def test_passages(spark):
    texts = ["One. Two!\tThree? Four… five.six\n\n7. 8", "。一。二！ 三", " . ! ", "", "a.\n b", "..  ..", "x"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string").orderBy("k").select(fingerprint.passages(F.col("t"))).collect()]
    assert got == [[p for p in re.split(r"\n|(?<=[.!?…])(?=[ \t])|(?<=[。！？])", t) if p.strip(" \t\r\x0b\x0c")] for t in texts]


def test_likeness_is_the_cosine_of_centred_lanes(spark):
    line = lambda k, n: " ".join(f"Sentence {k} has the number {i}." for i in range(n))
    df = spark.createDataFrame([(line("a", 30), line("a", 15) + " " + line("b", 20)), (line("c", 3), line("d", 5)), ("", line("d", 5)), ("x. y", "y. x")], "a string, b string")
    rows = df.select(fingerprint.lanes(F.col("a")).alias("a"), fingerprint.lanes(F.col("b")).alias("b")).select("a", "b", fingerprint.likeness(F.col("a"), F.col("b")).alias("got")).collect()
    for r in rows:
        a, b = (np.array(x[:-1], float) - x[-1] * 65535 / 2 for x in (r.a, r.b))
        want = 1.0 if r.a == r.b else 0.0 if not r.a[-1] or not r.b[-1] else min(max(a @ b / np.sqrt((a @ a) * (b @ b)), 0), 1)
        assert r.got == pytest.approx(want, abs=1e-9)


def test_sums_by_columns_are_those_by_arrays(spark, monkeypatch):
    texts = ["One. Two. One.\nThree", "", None, " \n\t", "x\n" * 40, "A. B! C? D… E", "\n".join(f"line {i}." for i in range(100))]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, a string").withColumn("b", F.reverse("a"))
    want = {r.k: (r.a, r.b) for r in df.select("k", fingerprint.lanes(F.col("a")).alias("a"), fingerprint.lanes(F.col("b")).alias("b")).collect()}
    for bits in (15, 3):
        monkeypatch.setattr(fingerprint, "CHUNK_BITS", bits)
        got = {r.k: (r.a, r.b) for r in fingerprint.vectors(df, ["k"], {"a": F.col("a"), "b": F.col("b")}).collect()}
        assert got == want


def test_likeness_of_half_equal_and_of_very_long_texts(spark):
    line = lambda k, n: " ".join(f"Sentence {k} has the number {i}." for i in range(n))
    lines = lambda k, n: "\n".join(f"{k}{i}" for i in range(n))
    shares = [(line("a", 40), line("a", 20) + " " + line("b", 20), 0.5), (line("a", 40), line("b", 40), 0), (line("a", 40), line("a", 6) + " " + line("b", 34), 0.15)]
    shares += [(lines("x", 66_000), lines("x", 33_000) + "\n" + lines("y", 33_000), 0.5), ("z\n" * 66_000, "z\n" * 67_000, 1)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(shares)], "i int, x string, y string").repartition(4)
    held = df.select("i", fingerprint.lanes(F.col("x")).alias("x"), fingerprint.lanes(F.col("y")).alias("y")).cache()
    for r in held.select("i", fingerprint.likeness(F.col("x"), F.col("y")).alias("got")).collect():
        assert abs(r.got - shares[r.i][2]) < 0.25
    # small shares count on the mean too, as they aren't cut off
    many = spark.createDataFrame([(line(f"p{i}", 20), line(f"p{i}", 3) + " " + line(f"q{i}", 17)) for i in range(100)], "x string, y string")
    mean = many.select(fingerprint.likeness(fingerprint.lanes(F.col("x")), fingerprint.lanes(F.col("y"))).alias("got")).agg(F.avg("got")).first()[0]
    assert abs(mean - 0.15) < 0.05


# op4


def pages(spark):
    big, small = "<p>" + "é" * 800, "<p>same"
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9\r\nX: y", big), (9, "http://a/9b", big), (3, None, small), (4, "u", small), (5, "u5", None), (6, "u6", ""), (None, "n", big), (7, "u7", "x" * 300_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archives_round_trip(spark):
    got = warc.archived(pages(spark)).collect()
    assert all(r.error is None and r.block_ok and r.payload_ok for r in got)
    want = Counter()
    for r in pages(spark).collect():
        payload = (r.html or "").encode()
        refers = 9 if len(payload) >= 1000 and r.html.startswith("<p>é") and r.page_id != 9 else None
        want[(r.page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if refers else "response", refers)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc.archived(pages(spark).limit(0)).count() == 0


def test_damaged_archives(tmp_path):
    import io

    good = warc.record(1, "u", b"payload" * 99, None)
    assert [r["payload_ok"] for r in warc.records(io.BytesIO(good + good))] == [True, True]
    for data in (good[:-20], good + b"junk", good[:30] + b"\0" * 9 + good[39:]):
        rows = list(warc.records(io.BytesIO(data)))
        assert rows[-1]["error"]
    import gzip

    lying = gzip.compress(gzip.decompress(good).replace(b"payloadpayload", b"Payloadpayload"))
    assert [r["payload_ok"] for r in warc.records(io.BytesIO(lying))] == [False]


# op5


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        share = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] for s in full} | share
        full |= over


def test_mixing(spark, docs):
    got = mixing.balanced(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len(split(r.text))) for r in docs.collect())
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    want = brute_targets(sizes)
    assert all(r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] for r in got)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in mixing.balanced(docs).collect())
    mix = mixing.repeated(docs)
    assert mix.count() == sum(r.copies for r in got) and mix.columns == docs.columns
    assert mixing.balanced(empty(docs)).count() == 0


def test_mix_keeps_columns_of_its_own_names(spark):
    names = ["target", "size", "mean", "lam", "sid", "source_size", "extras", "copies", "rank", "n"]
    rows = spark.range(60).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "repeat('w ', cast(5 + id AS int)) AS text", *[f"concat('{c}', id) AS `{c}`" for c in names], "map('k', id) AS tags")
    got = mixing.repeated(rows)
    assert got.columns == rows.columns and got.count() > 0
    assert all(r[c] == f"{c}{r.doc_id}" for r in got.collect() for c in names)


def test_mixing_comes_near_targets(spark):
    rows = spark.range(6000).selectExpr("id AS doc_id", "concat('s', id % 7) AS source", "repeat('w ', cast(1 + id * id % 97 AS int)) AS text")
    out = mixing.balanced(rows).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum(F.col("rate") * F.col("size")).alias("expected")).collect()
    assert all(abs(r.taken / r.target - 1) < 0.002 and r.expected == pytest.approx(r.target, rel=1e-4) for r in out)


# op6


def test_viterbi_is_best():
    lex = sentencepieces.Lexicon(PIECES)
    words = [" the", " their", " theirs", "banana", " 中文x", " hest", "🎉🎉", " xq\u0001z"]

    def brute(text):
        best = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            for begin in range(end):
                piece = lex.pieces.get(text[begin:end])
                if piece:
                    best[end] = max(best[end], best[begin] + piece[0])
            if text[end - 1] not in lex.pieces:
                best[end] = max(best[end], best[end - 1] + lex.unknown_score)
        return best[-1]

    score = {i: s for s, i in lex.pieces.values()}
    for word, ids in lex.segment(words):
        whole = sum(score[i] for i in ids if i in score) + sum(lex.unknown_score for c in word if c not in lex.pieces)
        assert whole == pytest.approx(brute(word)), word


def test_unigram_search_of_the_library_is_never_better():
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = pb.ModelProto()
    model.ParseFromString(Path(PIECES).read_bytes())
    model.trainer_spec.model_type = 1
    own = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    lex = sentencepieces.Lexicon(PIECES)
    score = {i: s for s, i in lex.pieces.values()}
    words = sorted({w for i in range(300) for w in ("".join(chr(97 + (i * j * 7) % 26) for j in range(1, 3 + i % 9)),)})
    got = dict(lex.segment([" " + w for w in words]))
    assert all(sum(score[i] for i in got[" " + w]) >= sum(score[i] for i in own.encode(w)) for w in words)
    assert sum(got[" " + w] == own.encode(w) for w in words) >= 0.95 * len(words)


def test_long_words_and_their_neighbours(spark, monkeypatch):
    lex = sentencepieces.Lexicon(PIECES)
    words = [" the", " theory" * 3 + "x" * 300, " theory" * 3 + "y", " thesis"]
    want = dict(lex.segment(words))
    monkeypatch.setattr(sentencepieces, "LONG", 20)
    assert dict(lex.segment(words)) == want
    text = "a" + "xyé中" * 100_000 + " end"  # one word of 400,000 characters
    row = sentencepieces.encoded(spark.createDataFrame([(1, text)], "doc_id long, text string"), PIECES).first()
    assert row.exact and row.n_tokens == len(row.ids)


def test_pieces_round_trip(docs):
    got = sentencepieces.encoded(docs, PIECES)
    rows = got.collect()
    assert all(r.exact and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    back = Counter((r.doc_id, r.text) for r in sentencepieces.decoded(got, PIECES).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert sentencepieces.encoded(empty(docs), PIECES).count() == 0


# op7


def test_url_rules(spark):
    cases = {
        "https://EXAMPLE.org/en/12?x#y": ("example.org", "/en/12", "example.org/en/1", "block"), "http://a.example.org/es/": ("a.example.org", "/es/", "example.org/es/", "block"),
        "http://x.org": ("x.org", "", None, "allow"), "http://x.org/": ("x.org", "/", "org/", "allow"), "http://x.com/de/1": ("x.com", "/de/1", "com/de/", "block"), "http://x.com/fr/1": ("x.com", "/fr/1", "com/fr/", "allow"),
        "http://notcom/de/1": ("notcom", "/de/1", None, "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "://?q": ("", "", None, "allow"), "ftp://a://b/c": ("a:", "//b/c", None, "allow"),
        "http://www.bad.net/p/?utm_source=1&b=2&a=1#f": ("www.bad.net", "/p/", None, "block"), "http://bad.net/p?a=1&b=2": ("bad.net", "/p", None, "block"), "http://bad.net/q": ("bad.net", "/q", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "x", True) for i, u in enumerate(cases)], "page_id long, url string, verdict string, listed boolean")
    listed = spark.createDataFrame([("bad.net/p?a=1&b=2",), ("bad.net/p?a=1&b=2",), (None,)], "canonical string")
    for most in (1 << 14, 0):  # broadcast, and joined by block
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judged(df, URL_RULES, listed, most).collect()}
        assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert all(r.verdict in ("allow", "block") for r in urlfilter.judged(df, URL_RULES, listed.limit(0)).collect())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_querys_list_decides(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    monkeypatch.setattr(urlfilter, "PER_BLOCK", 200)  # a filter so full that unlisted URLs pass it
    out = urlfilter.judged(pages, URL_RULES, thin(pages)).collect()
    free = [r for r in out if r.rule is None]
    blocked = [r for r in free if r.verdict == "block"]
    assert 0 < len(blocked) < len(free) / 4 and all(r.listed for r in blocked)
    assert any(r.maybe_listed and not r.listed and r.verdict == "allow" for r in free)  # what the exact join takes out
    bodies = {r.page_id: r.html for r in pages.collect()}
    own = {k: re.sub(r"<[^>]*>", " ", re.search(r"(?s)<article[^>]*>(.*)", h)[1].split("</article>")[0]) for k, h in bodies.items()}
    assert {r.page_id for r in out if r.listed} >= {k for k, t in own.items() if len(split(t)) < 100}
    monkeypatch.undo()
    assert {(r.page_id, r.verdict) for r in urlfilter.judged(pages, URL_RULES, thin(pages)).collect()} == {(r.page_id, r.verdict) for r in out}


def test_thin_articles(spark):
    rows = [("http://a.net/1/", "<article>" + "w " * 99), ("http://a.net/2", "<article class=x><p>" + "w<b> " * 100), ("http://a.net/3", "w"), (None, "<article>w"), ("http://a.net/4", None), ("http://a.net/5", "<article></article>" + "w " * 500)]
    assert {r.canonical for r in thin(spark.createDataFrame(rows, "url string, html string")).collect()} == {"a.net/1", "a.net/5", None}


def test_bloom_filter_has_no_false_negatives(spark):
    listed = spark.range(5000).selectExpr("concat('h', id, '.net/x') AS canonical")
    df = spark.range(10_000).selectExpr("id AS page_id", "concat('http://h', id, '.net/x') AS url")
    assert [urlfilter.blocks_for(n) for n in (0, 1, 16, 17, 33, 5000)] == [1, 1, 1, 2, 4, 512]
    out = urlfilter.judged(df, [], listed)
    joined = urlfilter.judged(df, [], listed, 0)
    assert Counter(joined.collect()) == Counter(out.collect())
    assert out.where("page_id < 5000 and not (maybe_listed and listed)").count() == 0 and out.where("page_id >= 5000 and listed").count() == 0
    assert out.where("page_id >= 5000 and maybe_listed").count() < 100


# op8


def shingled(text):
    w = split(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    inter = sum((a & b).values())
    return inter / max(1, sum(a.values()) + sum(b.values()) - inter)


def brute_classes(rows):
    sets = {k: shingled(t) for k, t in rows}
    root = {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    texts = dict(rows)
    for a, b in combinations(sorted(sets), 2):
        if texts[a] == texts[b] or jaccard(sets[a], sets[b]) >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def test_near_duplicates(docs, texts):
    got = bagminhash.classed(docs).collect()
    want = brute_classes(list(texts.items()))
    assert want[2] == 0 and want[3] == 3 and want[9] == 8
    assert all(r.class_id == want[r.doc_id] for r in got if r.doc_id is not None) and len(got) == docs.count()
    assert [r.class_id for r in got if r.doc_id is None] == [4]
    kept = bagminhash.one_of_each(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter([None, *sorted(set(want.values()))])
    assert bagminhash.classed(empty(docs)).count() == 0


def test_signatures_are_unbiased():
    a = " ".join(f"w{i % 97 if i < 150 else i}" for i in range(400))
    b = " ".join(f"w{i % 97 if i < 120 else i}" for i in range(60, 430))
    c = "x y z u v " * 40
    keys, n = bagminhash.shingles(*utf8(pa.array([a, b, c, "x y z u v " * 30])))
    reg = bagminhash.signatures(keys, 4, 4096)
    assert (reg[0] == reg[1]).mean() == pytest.approx(jaccard(shingled(a), shingled(b)), abs=0.03)
    assert (reg[2] == reg[3]).mean() == pytest.approx(jaccard(shingled(c), shingled("x y z u v " * 30)), abs=0.03)


def test_chains_and_large_groups(spark):
    from tests.llm.conftest import edited, prose

    base = prose(9, 200)
    rows = [(i, edited(base, i, 2)) for i in range(60)]
    chain = prose(10, 200).split(" ")
    rows += [(100 + i, " ".join(chain[4 * i : 4 * i + 120])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in bagminhash.classed(df).collect()}
    assert got == brute_classes(rows)


def test_buckets_in_blocks(spark, monkeypatch):
    from tests.llm.conftest import edited, prose

    base = prose(11, 150)
    rows = [(i, edited(base, i, 1 + i % 9)) for i in range(40)]
    want = {(a, b) for a, b in combinations(range(40), 2) if jaccard(shingled(rows[a][1]), shingled(rows[b][1])) >= 0.8}
    monkeypatch.setattr(bagminhash, "BLOCK", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signs = bagminhash.signed(df).select(F.col("doc_id").alias("node"), F.transform("bands", lambda b: F.lit(5).cast("long")).alias("bands"), "sketch", F.col("n_shingles").alias("n"))
    texts = df.withColumnRenamed("doc_id", "node")
    members, signs = signs.select(F.lit(5).cast("long").alias("bucket"), "node", "n", F.col("node").alias("class_id")), signs.drop("n")
    got = [(r.a, r.b) for r in bagminhash._linked(members, signs, texts).collect()]
    assert want and want == set(got) and len(got) == len(set(got))
    assert not bagminhash._linked(members.withColumn("class_id", F.lit(1).cast("long")), signs, texts).collect()
    # a class with blocks of its own meets all others, and is not held against itself
    classes = lambda k: 0 if k < 25 else k
    mixed = members.withColumn("class_id", F.when(F.col("node") < 25, F.lit(0)).otherwise(F.col("node")))
    got = [(r.a, r.b) for r in bagminhash._linked(mixed, signs, texts).collect()]
    assert set(got) == {(a, b) for a, b in want if classes(a) != classes(b)} and len(got) == len(set(got))
    met = bagminhash._in_blocks(mixed).groupBy("low", "high").agg(F.count_distinct("class_id").alias("n")).collect()
    assert all(r.n > 1 for r in met)


def test_centres_are_dealt_in_parts(spark, monkeypatch):
    from tests.llm.conftest import edited, prose

    base = prose(12, 300)
    rows = [(i, edited(base, i, i % 9)) for i in range(60)]
    monkeypatch.setattr(bagminhash, "TOGETHER", 4)
    df = spark.createDataFrame(rows, "node long, text string")
    pairs = df.where("node <> 9").select(F.lit(9).cast("long").alias("centre"), "node", F.lit(60).alias("size"))
    want = {(min(9, k), max(9, k)) for k, t in rows if k != 9 and jaccard(shingled(rows[9][1]), shingled(t)) >= 0.8}
    assert 5 < len(want) < 55 and {(r.a, r.b) for r in bagminhash._verified(pairs, df).collect()} == want


def test_rows_that_share_an_id_may_have_columns_of_any_type(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 'a b c', map('k', 1), 'x'), (1L, 'a b c', map('k', 0), 'x'), (1L, NULL, map('k', 2), 'y'), (2L, 'a b c', NULL, 'z') AS t(doc_id, text, tags, class_id)")
    got = bagminhash.one_of_each(df)
    assert got.columns == df.columns and got.count() == 1


# op9


def test_fertility(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = fertility.judged(docs, PIECES).collect()
    want = Counter()
    for r in docs.collect():
        text, w = r.text or "", split(r.text)
        lines = [x for x in text.split("\n") if split(x)]
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {i + j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(8)}
        ids = [i for x in w for i in sp.encode(x)]
        p = np.array(list(Counter(ids).values())) / max(len(ids), 1)
        entropy = round(float(-(p * np.log2(p)).sum()), 6) + 0.0
        failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
        want[(r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), len(ids), entropy, failed)] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_tokens, round(r.token_entropy, 6) + 0.0, r.base_failed) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed) and sum(r.kept for r in got) >= 20
    assert fertility.judged(empty(docs), PIECES).count() == 0


def test_odd_texts_fall_out_of_their_band(spark):
    from tests.llm.conftest import prose

    rows = [(i, prose(500 + i, 150), "en") for i in range(80)] + [(900, " ".join(f"\U0001f389\U0001f38a{chr(0x1F300 + i % 90)}" for i in range(150)), "en")]
    got = {r.doc_id: r.kept for r in fertility.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES).collect()}
    assert not got[900] and sum(got.values()) >= 79


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_planted_odd_texts_are_caught(spark):
    """Mis-encoded, damaged and meaningless texts among all documents of known language: at least 95 % of each kind fall out, and no more of the others."""
    import base64
    import random

    rng = random.Random(3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in docs.collect() if r.text and len(r.text.split()) >= 60]
    kinds = [
        lambda w: w.replace("e", "é").encode().decode("latin-1"), lambda w: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in w), lambda w: base64.b64encode(rng.randbytes(max(3, len(w)))).decode(),
        lambda w: rng.randbytes(4).hex(), lambda w: "".join("\ufffd" if rng.random() < 0.3 else c for c in w),
    ]
    plant = [(10**7 + 100 * j + i, " ".join(map(f, r.text.split())), r.lang) for j, f in enumerate(kinds) for i, r in enumerate(rng.sample(rows, 20))]
    out = fertility.judged(docs.unionByName(spark.createDataFrame(plant, "doc_id long, text string, lang string")), PIECES, BPE).collect()
    caught = Counter((r.doc_id - 10**7) // 100 for r in out if r.doc_id >= 10**7 and not r.kept)
    assert all(caught[j] >= 19 for j in range(len(kinds)))
    good = [r for r in out if r.doc_id < 10**7 and not r.base_failed]
    assert sum(not r.kept for r in good) <= 0.005 * len(good)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_verdicts_against_brute_force(spark, tokenizer):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = fertility.judged(table, PIECES, BPE).collect()
    texts = {r.doc_id: r.text for r in table.collect()}
    shown = {chr(wavelet.SHOWN.get(b, b)) for b in range(128, 256)}
    single = {i for p, i in tokenizer.get_vocab().items() if p.removeprefix(wavelet.LEAD) in shown}
    for r in got[::25]:
        ids = [i for w in split(texts[r.doc_id]) for i in tokenizer.encode(" " + w, add_special_tokens=False).ids]
        p = np.array(list(Counter(ids).values())) / max(len(ids), 1)
        assert r.n_tokens_2 == len(ids) and r.byte_share_2 == pytest.approx(sum(i in single for i in ids) / max(len(ids), 1)) and r.token_entropy_2 == pytest.approx(float(-(p * np.log2(p)).sum()), abs=1e-6)
    value = lambda r, c, x: math.log2(max(r[f"n_tokens{x}"], 1)) - r[f"token_entropy{x}"] if c == "entropy_gap" else r[f"{c}{x}"]
    good = [r for r in got if not r.base_failed]
    groups = Counter(r.grp for r in good)
    want = {}
    for r in got:
        base, odd = [g for g in good if g.grp == r.grp or groups[r.grp] < fertility.LEAST_GROUP], False
        for x in ("", "_2"):
            for c, least in fertility.LEAST_SD.items():
                key = (r.grp if groups[r.grp] >= fertility.LEAST_GROUP else None, c, x)
                if key not in want:
                    want[key] = np.quantile([value(g, c, x) for g in base], [0.25, 0.5, 0.75])
                q1, mid, q3 = want[key]
                half, v = fertility.SPREAD * max((q3 - q1) / 1.349, least), value(r, c, x)
                odd |= v > mid + half or (c == "chars_per_token" and v < mid - half)
        assert r.kept == (not r.base_failed and not odd), r.doc_id
    assert sum(r.kept for r in good) > 0.95 * len(good)


# op10


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(2)
    x = rng.integers(97, 103, 500).astype(np.uint64)
    keys = (x[:-3] << np.uint64(48)) | (x[1:-2] << np.uint64(32)) | (x[2:-1] << np.uint64(16)) | x[3:]
    keys, counts = np.unique(keys, return_counts=True)
    model = langid.fit({"l": (keys, counts)})
    for context in (keys[5] >> np.uint64(16), keys[9] >> np.uint64(16), np.uint64((97 << 32) | (97 << 16) | 200)):
        grams = (np.uint64(context) << np.uint64(16)) | np.arange(97, 103, dtype=np.uint64)
        total = np.exp(model.rows(grams)).sum() + np.exp(model.rows((np.uint64(context) << np.uint64(16)) | np.array([999], np.uint64))).sum()
        assert total == pytest.approx(1, abs=1e-4)


def kneser_ney(texts):
    """Plain interpolated Kneser-Ney: a function from (context, character) to a probability, from a language's normalised texts."""
    whole = Counter(("   " + t)[i : i + 4] for t in texts for i in range(len(t)))
    levels = {4: whole}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])  # distinct left extensions
    tables = {}
    for n, grams in levels.items():
        once, two = (sum(c == k for c in grams.values()) for k in (1, 2))
        total, kinds = Counter(), Counter()
        for g, c in grams.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        tables[n] = grams, min(0.95, max(0.1, once / (once + 2 * two))) if once else 0.5, total, kinds

    def p(context, c, n=4):
        if n == 0:
            return 1 / (len(levels[1]) + 1)
        grams, d, total, kinds = tables[n]
        context = context[len(context) - n + 1 :]
        lower = p(context, c, n - 1)
        if context not in total:
            return lower
        return max(grams[context + c] - d, 0) / total[context] + d * kinds[context] / total[context] * lower

    return p


def test_languages_against_brute_force(spark):
    """Every cross-entropy, language and score of a plain model over dicts, wherever in a step a text lies."""
    rng = np.random.default_rng(8)
    parts = {"en": ["the", "ing", "on", "at", "er"], "fr": ["le", "é", "ai", "eux", "on"], "de": ["sch", "ü", "er", "ein", "at"]}
    ends = [" ", ", ", "\n", " 12 ", "! ", "'"]
    make = lambda x, n: "".join(str(rng.choice(["", "7 ", " "])) + "".join(rng.choice(parts[x], 2)).capitalize() + str(rng.choice(ends)) for _ in range(n))
    rows = [(k, make(x, int(rng.integers(1, 30))), x) for k, x in enumerate(list(parts) * 60)] + [(900 + k, t, "en") for k, t in enumerate(["", "12 3", "  a", "日本語 Ωμέγα", "Zzz qq"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fold = lambda k: zlib.crc32(str(k).encode()) % 4
    norm = lambda t: re.sub(" +", " ", "".join(c.lower()[0] if c.isalpha() else " " for c in t + "\n")).lstrip(" ")
    plain = {x: kneser_ney([norm(t) for k, t, own in rows if own == x and fold(k) < 2]) for x in parts}
    model = langid.train(df)
    for cut in (1, 3):
        got = {r.doc_id: r for r in langid.predicted(df.repartition(cut), model).collect()}
        assert len(got) == len(rows)
        for k, t, _ in rows:
            t = norm(t)
            if not t:
                assert got[k].lang_pred == "und"
                continue
            padded = "   " + t
            ce = {x: -sum(np.log(p(padded[i : i + 3], padded[i + 3])) for i in range(len(t))) / len(t) for x, p in plain.items()}
            best = min(ce, key=ce.get)
            assert got[k].lang_pred == best or ce[got[k].lang_pred] - ce[best] < 1e-4
            assert got[k].cross_entropy == pytest.approx(ce[best], abs=1e-4)
            assert got[k].score == pytest.approx(1 / sum(np.exp((ce[best] - v) * min(len(t), langid.EVIDENCE_CHARS)) for v in ce.values()), abs=2e-3)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_language_of_held_out_documents(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(table)
    out = langid.predicted(table, model).join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.where("lang = lang_pred").count() >= 0.97 * out.count() and out.where("rejected").count() <= 0.02 * out.count()
    fold = {r.doc_id: r.held_out for r in out.select("doc_id", "held_out").collect()}
    assert all(zlib.crc32(str(k).encode()) % 4 == 2 for k in fold)
    odd = {(r.doc_id): r for r in langid.predicted(docs, model).collect()}
    assert odd[5].lang_pred == odd[6].lang_pred == odd[7].lang_pred == odd[14].lang_pred == "und" and odd[5].score == 0
    assert not odd[None].held_out and all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in odd.items() if k is not None)
    assert all(0 <= r.score <= 1 for r in odd.values()) and set(langid.accepted(docs, model).columns) == set(docs.columns)
    foreign = spark.createDataFrame([(1, "これは日本語の文章です。" * 20, "x")], "doc_id long, text string, lang string")
    assert langid.predicted(foreign, model).first().rejected and langid.accepted(foreign, model).count() == 0


def test_language_without_training_rows(docs):
    assert langid.train(docs.where("lang is null")) is None and langid.train(empty(docs)) is None
    assert {r.lang_pred for r in langid.predicted(docs, None).collect()} == {"und"}


def test_texts_that_keep_no_character(spark):
    said = ["the cat sat on the mat and looked at the rain", "le chat est assis sur le tapis et regarde la pluie"]
    schema = "doc_id long, text string, lang string"
    learn = [(i, f"{said[i % 2]} {'abcdefghij'[i % 10]}", ["en", "fr"][i % 2]) for i in range(200)]
    # the letterless rows come last in the calibrating fold too
    train = learn + [(i, t, "en") for i in range(1000, 1040) for t in ["", "123"]]
    model = langid.train(spark.createDataFrame(train, schema).coalesce(1))
    alone = langid.predicted(spark.createDataFrame([(0, "abc", "en")], schema), model).first()
    for case in (["abc", None], [None, None], ["abc", "123"], ["abc", ""], ["abc", None, "abc", " \n"]):
        docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(case)], schema).coalesce(1)
        got = langid.predicted(docs, model).orderBy("doc_id").collect()
        assert [r.lang_pred for r in got] == [alone.lang_pred if t == "abc" else "und" for t in case]
        assert all(r.cross_entropy == alone.cross_entropy for r, t in zip(got, case, strict=True) if t == "abc")
        assert [r.doc_id for r in langid.accepted(docs, model).collect()] == [i for i, t in enumerate(case) if t == "abc" and not alone.rejected]


def test_no_language_is_lost_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 1000)
    fold = lambda k: zlib.crc32(str(k).encode()) % 4
    third = [k for k in range(2000, 2100) if fold(k) == 3][:5]
    said = {"en": "the cat sat on the mat and looked at the rain. ", "fr": "le chat est assis sur le tapis et regarde la pluie. ", "de": "die katze sitzt auf der matte und sieht den regen. "}
    rows = [(k, said["en"], "en") for k in range(100)]
    rows += [(k, said["fr"] * 20_000, "fr") for k in range(1000, 1010)] + [(k, said["de"], "de") for k in third]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert model.langs == ["de", "en", "fr"]
    got = langid.predicted(df.where("lang <> 'fr'").unionByName(df.where("lang = 'fr'").limit(1)), model).join(df.select("doc_id", "lang"), "doc_id").distinct()
    assert got.where("lang <> lang_pred").count() == 0


def test_junk_does_not_lift_the_limit(spark):
    rng = np.random.default_rng(5)
    words = ["the", "an", "er", "on", "in", "ing", "ti", "re", "at", "es", "ou", "ha"]
    prose = lambda: " ".join("".join(rng.choice(words, 3)) for _ in range(40))
    junk = lambda: "".join(chr(0x3041 + int(c)) for c in rng.integers(0, 80, 200))
    schema = "doc_id long, text string, lang string"
    third = [k for k in range(5000, 5400) if zlib.crc32(str(k).encode()) % 4 == 3][:10]
    model = langid.train(spark.createDataFrame([(k, prose(), "en") for k in range(1200)] + [(k, junk(), "en") for k in third], schema))
    got = langid.predicted(spark.createDataFrame([(k, junk() if k < 5 else prose(), "en") for k in range(105)], schema), model).collect()
    assert [r.rejected for r in sorted(got, key=lambda r: r.doc_id)] == [True] * 5 + [False] * 100


# pipeline and queries


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from sondage.llm.shared import written

    if not Path(SF).exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, last = docs.columns, None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, written(stage(spark, docs, SF), name)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if name == "near_duplicates":
            want = brute_classes([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in docs.collect()} == set(want.values())
        if name == "personal_data":
            assert docs.count() == before.count()
        last = before
    assert docs.count() == last.count() and docs.where("not exact").count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == Counter(res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op8_bagminhash", "op11_negatives", "op13_filteraudit"}))
def test_queries_run(spark, name):
    if not Path(SF).exists():
        pytest.skip("no test tables")
    table = "pages" if name in ("op4_warc", "op7_urlfilter") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_a_task_gives_its_memory_back():
    """What the functions of a task keep for its steps goes with the task."""
    from sondage.llm import shared

    def run(batches):
        shared.POWERS.upto(1 << 12)
        yield from batches

    assert list(shared.frugal(run)([1, 2])) == [1, 2]
    assert len(shared.POWERS.up) == len(shared.POWERS.down) == 1
