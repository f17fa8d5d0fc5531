"""Operators 1, 3, 4, 5, 6, 7 and 8 against plain Python, libraries or held-out rows."""

import base64
import collections
import datetime
import gzip
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from conftest import SF001
from llm import brute
from pyspark.sql import functions as F

import corpus_pipeline
from prefpairs.llm import archives, langid, pieces, pseudonyms, simhash, sketches, substring
from prefpairs.llm.queries import QUERIES

MODEL_PATH = corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF001}/documents.parquet").to_pylist()


# --- 1: pseudonyms ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def own():
    return pseudonyms.Pseudonymiser(b"test key")


def _card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return body + pseudonyms.luhn_digit(body)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 5000])
def test_feistel_is_a_permutation(size):
    f = pseudonyms.Feistel(b"k", "x", size)
    assert sorted(f.walk(x) for x in range(size)) == list(range(size))


def test_walk_stays_in_the_valid_values():
    f, odd = pseudonyms.Feistel(b"k", "x", 1000), lambda x: x % 3 == 1
    assert sorted(f.walk(x, odd) for x in range(1000) if odd(x)) == [x for x in range(1000) if odd(x)]


def test_cards_keep_format_and_check_digit(own):
    rng = random.Random(1)
    cards = [_card(rng) for _ in range(300)]
    new = [own.card(c) for c in cards]
    assert all(n != c and n[0] == "4" and pseudonyms.luhn_digit(n[:-1]) == n[-1] for n, c in zip(new, cards, strict=True))
    assert len(set(new)) == len(set(cards))
    spaced = " ".join(cards[0][k : k + 4] for k in range(0, 16, 4))
    assert own.card(spaced).replace(" ", "") == new[0]
    assert own.card("4111111111111112") is None


def test_kinds_in_texts(own):
    rng = random.Random(2)
    card = _card(rng)
    text = f"Pay {card}. Call +1 (988) 555-2485 4.4.8.8, or (212) 555-0123; SSN 123-45-6789, mail hsr.29@mail5.example.com on 2019-02-28, 28.02.2019, Feb 28, 2019 and 28 February 2019 from 42.144.35.254!! GB82 WEST 1234 5698 7654 32"
    new, found = own.text(text)
    assert found == {"card": 1, "phone": 2, "ip": 2, "ssn": 1, "email": 1, "date": 4, "iban": 1}
    for secret in (card, "555-2485", "555-0123", "123-45-6789", "hsr.29", "2019-02-28", "42.144.35.254", "5698 7654"):
        assert secret not in new
    shape = lambda s: re.sub("[0-9]+", "9", re.sub("[A-Za-z]", "a", s))
    plain = r"(?:[A-Z][a-z]+ [0-9]+, |[0-9]+ [A-Z][a-z]+ )[0-9]{4}"
    assert shape(re.sub(plain, "", new)) == shape(re.sub(plain, "", text))
    dates = [datetime.date.fromisoformat(re.search(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", new)[0]), datetime.datetime.strptime(re.search(r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}", new)[0], "%d.%m.%Y").date()]
    assert dates[0] == dates[1]  # one day, one pseudonym, in every notation
    assert f"{dates[0].day}, {dates[0].year}" in new
    iban = re.search("GB[0-9]{2} [A-Z]{4} [0-9 ]+", new)[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_invalid_values_stay(own):
    text = "1234567890123456 999.1.2.3 2021-02-30 000-12-3456 31.13.2020 version 1.2.3 127.0.0.1 +12"
    assert own.text(text) == (text, {})


@pytest.mark.parametrize(
    ("value", "kind"),
    [("4111 1111 1111 1111", "card"), ("3782 822463 10005", "card"), ("AT61 1904 3002 3457 3201", "iban"), ("ES91 2100 0418 4502 0005 1332", "iban"), ("+45 32 12 34 56", "phone")],
)
@pytest.mark.parametrize("around", ["{} 12/25", "{} 123", "{} 12 / 2025", "{} BIC GENODEF1", "{} 99 11", "12 {}", "no. 0000 {}, 5"])
def test_values_beside_other_groups(own, value, kind, around):
    """More digits or capitals beside a value leave it its own pseudonym."""
    new = getattr(own, kind)(value)
    assert new != value and own.text(around.format(value)) == (around.format(new), {kind: 1})


def test_every_day_in_every_notation(own):
    """One pseudonym for a day in all notations, another for every other day."""
    english = pseudonyms.MONTHS[0][1]
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(k) for k in range(366)]
    new = {}
    for d in days:
        got = datetime.date.fromisoformat(own.date(d.isoformat()))
        assert datetime.datetime.strptime(own.date(f"{d:%d.%m.%Y}"), "%d.%m.%Y").date() == got
        assert datetime.datetime.strptime(own.date(f"{d:%m/%d/%Y}"), "%m/%d/%Y").date() == got
        assert own.date(f"{english[d.month - 1]} {d.day}, {d.year}") == f"{english[got.month - 1]} {got.day}, {got.year}"
        if d.day > 12:  # else it reads as month first
            assert datetime.datetime.strptime(own.date(f"{d:%d/%m/%Y}"), "%d/%m/%Y").date() == got
        new[d] = got
    assert len(set(new.values())) == len(days)


def test_dates_of_the_corpus_languages(own):
    """One day, one pseudonym: timestamps and named months of all four languages."""
    day = datetime.date.fromisoformat(own.date("2019-02-28"))
    names = {language: names for language, names in reversed(pseudonyms.MONTHS) if names[0][0].islower() == (language in ("fr", "es"))}
    d, m, y = day.day, day.month - 1, day.year
    text = "2019-02-28T10:00:00Z, 2019-02-28t10:00, 2019-02-28 10:00|28. Februar 2019|28 février 2019|28 fevrier 2019|28 de febrero de 2019|28 de Febrero del 2019|28 févr. 2019|28 Feb. 2019"
    new, found = own.text(text)
    parts = new.split("|")
    assert found == {"date": 10}
    assert parts[0] == f"{day}T10:00:00Z, {day}t10:00, {day} 10:00"
    assert parts[1] == f"{d}. {names['de'][m]} {y}" and parts[2] == f"{d} {names['fr'][m]} {y}"
    assert parts[4] == f"{d} de {names['es'][m]} de {y}" and parts[5] == f"{d} de {names['es'][m].capitalize()} del {y}"
    assert all(p.startswith(f"{d} ") and p.endswith(f" {y}") for p in parts[2:])
    first = datetime.date.fromisoformat(own.date("2020-01-01"))
    assert own.text("le 1er janvier 2020")[0] == f"le {first.day}{'er' if first.day == 1 else ''} {names['fr'][first.month - 1]} {first.year}"
    assert own.text("1er Februar 20190 2019-02-28Tx 31 de febrero de 2019")[1] == {}


def test_short_groups_of_telephone_numbers(own):
    bare, found = own.text("+33123456789")
    assert found == {"phone": 1}
    for written in ("+33 1 23 45 67 89", "+33 1 23 45 67 89 12", "+33-1-23-45-67-89", "+33 123 456 789"):
        new, found = own.text(written)
        assert found == {"phone": 1} and re.sub("[^0-9]", "", new)[:11] == bare[1:]
        assert re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", written)
    assert own.text("+33 6 12 34 56 78")[1] == {"phone": 1} and own.text("+2 3 4 5, +12")[1] == {}


def test_number_tables_hold_no_cards(own):
    years = " ".join(str(y) for y in range(1900, 2020))
    assert "card" not in own.text(" ".join(str(k % 90 + 10) for k in range(20)))[1] and own.text(years)[1].get("card", 0) <= 2


def test_private_addresses_stay_private(own):
    for a in ("10.1.2.3", "172.16.0.9", "192.168.1.1"):
        assert own.ip(a) != a and re.match(r"10\.|172\.(1[6-9]|2[0-9]|3[01])\.|192\.168\.", own.ip(a))


def test_values_stay_linked_across_documents(spark, own):
    rows = [(k, f"doc {k}: +1 (988) 555-2485 and 42.144.35.254") for k in range(40)] + [(99, None)]
    out = pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), b"test key").collect()
    assert len({r.text.split(": ")[1] for r in out if r.text}) == 1
    assert [(r.text, r._ps_ip) for r in out if r.doc_id == 99] == [(None, 0)]
    other = pseudonyms.pseudonymise(spark.createDataFrame(rows[:1], "doc_id long, text string"), b"other key").first()
    assert other.text not in {r.text for r in out}


def test_only_valid_values_change(spark, documents):
    out = {r.doc_id: r for r in QUERIES["op1_pii_pseudonyms"](spark, SF001).collect()}
    for d in documents:
        r = out[d["doc_id"]]
        found = sum(getattr(r, f"n_{k}") for k in pseudonyms.KINDS)
        assert (r.text == d["text"]) == (found == 0) and len(r.text.split("\n")) == len(d["text"].split("\n"))


# --- 3: archives -----------------------------------------------------------------------


def test_query_warc(spark):
    pages = pq.read_table(f"{SF001}/pages.parquet").to_pylist()
    last = {}
    for p in pages:
        last[p["html"] or ""] = max(last.get(p["html"] or "", -1), p["page_id"])
    want = set()
    for p in pages:
        data, of = (p["html"] or "").encode(), last[p["html"] or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.add((p["page_id"], len(data), digest, *(("response", None) if of == p["page_id"] else ("revisit", of))))
    got = QUERIES["op3_warc"](spark, SF001).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert len(got) == len(pages) and {tuple(r) for r in got} == want


def test_arc_versions_and_faults():
    def archive(version, *docs):
        out = [archives.version_block("x.arc", version, "19961231235959")]
        return b"\n".join(out + [archives.record_line("x.arc", version, 0, u, d, "text/html", len(b)) + b for u, d, b in docs]) + b"\n"

    http = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\nwith filedesc://breaks\r\n"
    for version in (1, 2):
        data = archive(version, ("http://a/b c", "20010203040506", http), ("dns:a", "200102", b"1.2.3.4"))
        for content in (data, gzip.compress(data[:200]) + gzip.compress(data[200:])):
            info, page, dns = archives.arc_records(content)
            assert (info["kind"], page["kind"], dns["kind"]) == ("warcinfo", "response", "resource")
            assert (page["url"], page["date"], page["payload"]) == ("http://a/b c", "2001-02-03T04:05:06Z", b"body\n\nwith filedesc://breaks\r\n")
            assert dns["date"] == "2001-02-01T00:00:00Z" and dns["payload"] == b"1.2.3.4"
            assert len({info["record_id"], page["record_id"], dns["record_id"]}) == 3
    cut = list(archives.arc_records(archive(1, ("u", "2001", http))[:-20]))
    assert cut[-1]["error"] == "cut short"
    wrong = archive(1, ("u", "20010203040506", http)).replace(b"text/html", b"text/html x", 1).replace(b"u 0.0", b"0.0")
    assert [r["error"] for r in archives.arc_records(b"http://a 1 2 t 3\nabc\n")] == ["no version block"]
    assert list(archives.arc_records(b"")) == [] and wrong


def test_pages_named_like_version_blocks(spark):
    urls = ["http://a/1", "filedesc://x", "filedesc://a 1 0 x", "http://a/2", "filedesc://"]
    pages = spark.createDataFrame([(i, urls[i % 5], f"<p>{i}</p>") for i in range(40)], "page_id long, url string, html string").repartition(3)
    path = archives.through_archives(pages)
    rows = archives.resolve_revisits(archives.read_warc(spark, path)).collect()
    assert sorted((r.key, r.url, bytes(r.payload).decode()) for r in rows) == [(i, urls[i % 5].replace(" ", "%20"), f"<p>{i}</p>") for i in range(40)]


def test_joined_archives_of_both_versions():
    data = b""
    for version in (1, 2, 1):
        data += archives.version_block(f"v{version}.arc", version, "19961231235959") + b"\n"
        data += archives.record_line("x", version, 0, "filedesc://p", "2001", "text/html", 3) + b"abc\n"
    got = [(r["kind"], r["version"], r["error"]) for r in archives.arc_records(data)]
    assert got == [(kind, version, None) for version in (1, 2, 1) for kind in ("warcinfo", "resource")]


def test_warc_files_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(5)
    pages = [(i, f"http://a/{i}", rng.randbytes(200_000).hex()) for i in range(120)]
    old, path = str(tmp_path / "arc"), str(tmp_path / "warc")
    archives.write_arc(spark.createDataFrame(pages, "page_id long, url string, html string"), old)
    settings = {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}  # all records in one writing task
    kept = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        archives.convert(archives.read_arc(spark, old).coalesce(1), archives.record_key(F.col("head")), path)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    sizes = [len(gzip.decompress(bytes(f.content))) for f in files]
    assert sum(sizes) > archives.WARC_BYTES and max(sizes) <= archives.WARC_BYTES + 4
    rows = archives.resolve_revisits(archives.read_warc(spark, path)).collect()
    assert {(r.key, bytes(r.payload).decode()) for r in rows} == {(i, html) for i, _, html in pages} and len(rows) == 120
    huge = [pa.RecordBatch.from_pydict({"record": [b"x" * (archives.WARC_BYTES + 1), b"y", b"z"]})]
    assert [b.column(0)[0].as_py()[-6:] for b in archives._joined(huge)] == [b"x" * 6, b"y\r\n\r\nz"]


def test_conversion_fails_on_faulty_records(spark, tmp_path):
    data = archives.version_block("x.arc", 1, "19961231235959") + b"\n" + archives.record_line("x", 1, 0, "u", "2001", "text/html", 9) + b"abc\n"
    (tmp_path / "x.arc.gz").write_bytes(gzip.compress(data))
    arc = archives.read_arc(spark, str(tmp_path))
    assert [r.error for r in arc.collect()] == [None, "cut short"]
    with pytest.raises(Exception, match="cut short"):
        archives.convert(arc, F.lit(0), str(tmp_path / "warc"))
    archives.convert(arc.filter("error is null"), F.lit(0), str(tmp_path / "good"))
    assert [r.type for r in archives.read_warc(spark, str(tmp_path / "good")).collect()] == ["warcinfo"]


# --- 4: pieces -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.Model(pieces.read_model(MODEL_PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)


def _same(model, library, text):
    ids = np.frombuffer(model.encode(text), np.int32).tolist()
    assert ids == library.encode(text), text[:80]
    assert model.decode(ids) == library.decode(ids), text[:80]


def test_pieces_on_white_space_runs(model, library):
    for n in range(120):
        for text in (" " * n, " " * n + "the", "a" + " " * n + "\n" + " " * n, "\t" * n, "\n" * n + "x"):
            _same(model, library, text)


def test_pieces_on_random_texts(model, library):
    rng = random.Random(4)
    chars = [chr(c) for c in [*range(256), 0x2581, 0x4E2D, 0x1F600, 0xFFFD, 0x200D, 0xFB01, 0x300, 0x10FFFF]]
    own = list(model.ids)
    for _ in range(1500):
        _same(model, library, "".join(rng.choice(chars) for _ in range(rng.randint(0, 30))))
        _same(model, library, "".join(rng.choice(own) for _ in range(rng.randint(1, 6))))
        _same(model, library, "".join(rng.choice("ab. ,\n;:!?1") for _ in range(rng.randint(0, 25))))


def test_pieces_of_long_words(model, library):
    for text in ("a" * 5000, "the" * 3000, "é" * 2000, "\U0001f9ff" * 500, "<s></s><unk><0x41>"):
        _same(model, library, text)


def test_query_sentencepiece(spark, library, documents):
    got = {r.doc_id: r for r in QUERIES["op4_sentencepiece"](spark, SF001).collect()}
    assert len(got) == len(documents)
    for d in documents:
        ids, r = library.encode(d["text"] or ""), got[d["doc_id"]]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids)))


def test_pieces_of_nulls(awkward, library):
    proto = pieces.read_model(MODEL_PATH)
    for r in pieces.decode(pieces.encode(awkward, proto), proto).collect():
        assert r._sp_ids == library.encode(r.text or "") and r._sp_text == library.decode(r._sp_ids)


# --- 5: sketches -----------------------------------------------------------------------

PIECES = re.compile(rf"[^\n]{{{sketches.PARAGRAPH},}}?[.!?](?=[\x20\x09-\x0D]|$)|[^\n]+")


def _likeness(a, b):
    a, b = (collections.Counter(PIECES.findall(t)) for t in (a, b))
    total = sum(a.values()) + sum(b.values())
    return 1 - (sum((a - b).values()) + sum((b - a).values())) / total if total else 1.0


def _check_fingerprints(rows, got):
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        text, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited) == (len(text), edited)
        assert r.near_edited == pytest.approx(_likeness(text, edited)) and r.near_next == pytest.approx(_likeness(text, nxt))


def test_query_fingerprints(spark, documents, monkeypatch):
    monkeypatch.setattr(sketches, "RANGE_DOCS", 30)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.id: r for r in sketches.compare_edits(docs).collect()}
    _check_fingerprints([(d["doc_id"], d["text"]) for d in documents], got)
    by_text = collections.defaultdict(set)
    for d in documents:
        by_text[d["text"]].add(got[d["doc_id"]].fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len(by_text) == len({r.fingerprint for r in got.values()})


def test_sketches_retry_larger(spark):
    """Hundreds of differing paragraphs, repeated ones, and sparse ids."""
    rng = random.Random(5)
    rows = [(k * 10**15 - 3, "\n".join(f"p{rng.randint(0, 400)}" for _ in range(n))) for k, n in enumerate([0, 1, 5, 60, 300, 900, 2])]
    rows += [(7, "same\n" * 500), (8, "same\n" * 499 + "other"), (9, None)]
    got = {r.id: r for r in sketches.compare_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    _check_fingerprints(rows, got)


def test_lone_and_repeated_documents(spark, awkward):
    one = spark.createDataFrame([(1, "alone")], "doc_id long, text string")
    r = sketches.compare_edits(one).first()
    assert (r.edited, r.near_next) == ("alo" + "al", 1.0)
    assert sketches.compare_edits(awkward).count() == awkward.count()


# --- 6: substrings ---------------------------------------------------------------------


def _check_substring(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = collections.Counter(tuple(r) for r in substring.substring_dedup(docs, **kw).collect())
    assert got == collections.Counter(brute.substring(rows, kw.get("length", 13)))


def test_query_substring(spark, documents):
    got = {tuple(r) for r in QUERIES["op6_substring_dedup"](spark, SF001).collect()}
    want = {(i, n, k, brute.sha(text)) for i, n, k, text in brute.substring([(d["doc_id"], d["text"]) for d in documents])}
    assert got == want


@pytest.mark.parametrize("length", [1, 2, 5, 13])
def test_substring_windows(spark, length, monkeypatch):
    """Small batches, so that entries of one hash come from many of them."""
    monkeypatch.setattr(substring, "BATCH_ENTRIES", 50)
    rng = random.Random(length)
    rows = [(rng.randint(-5, 40), " ".join(rng.choice("abc") if length < 5 else rng.choice("ab") for _ in range(rng.randint(0, 60)))) for _ in range(60)]
    _check_substring(spark, rows, length=length)


def test_substring_shared_passage(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, " ".join(f"u{k}x{j}" for j in range(k % 17)) + " " + passage + "\t\n" + " ".join(f"v{k}x{j}" for j in range(k % 5))) for k in range(120)]
    _check_substring(spark, rows)


def test_substring_awkward(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = collections.Counter(tuple(r) for r in substring.substring_dedup(awkward).collect())
    assert got == collections.Counter(brute.substring(rows))


# --- 7: SimHash ------------------------------------------------------------------------


def _check_simhash(rows, got):
    fps = [brute.simhash(t) for _, t in rows]
    roots = brute.components(fps)
    low = {}
    for (i, _), root in zip(rows, roots, strict=True):
        if i is not None:
            low[root] = min(low.get(root, i), i)
    want = collections.Counter((i, f, low.get(root)) for (i, _), f, root in zip(rows, fps, roots, strict=True))
    assert collections.Counter(got) == want


def test_query_simhash(spark, documents):
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op7_simhash"](spark, SF001).collect()]
    _check_simhash([(d["doc_id"], d["text"]) for d in documents], got)


def test_simhash_awkward(awkward):
    out = simhash.near_duplicates(awkward).collect()
    _check_simhash([(r.doc_id, r.text) for r in awkward.collect()], [(r.id, r.fp % 2**64, r["first"].id) for r in out])
    kept = simhash.keep_one(awkward).collect()
    assert len(kept) == len({(r["first"].id, r["first"].key) for r in out})


def _cloud(rng, centres, each, flips):
    out = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            x = c
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return np.unique(np.array(out, np.uint64))


def _clusters(n, a, b, x):
    at = {int(v): k for k, v in enumerate(x)}
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        i, j = find(at[p]), find(at[q])
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize(("centres", "each", "flips"), [(300, 5, 3), (1, 1500, 4), (20, 60, 8), (1500, 1, 0)])
def test_shard_links_find_every_pair(centres, each, flips, monkeypatch):
    x = _cloud(random.Random(centres), centres, each, flips)
    want = brute.components(x.tolist())
    monkeypatch.setattr(simhash, "LEAF", 32)
    assert _clusters(len(x), *simhash.shard_links(x, 2), x) == want
    monkeypatch.setattr(simhash, "_divide", lambda *_: None)  # a cloud that nothing divides
    monkeypatch.setattr(simhash, "LEAF", 1)
    assert _clusters(len(x), *simhash.shard_links(x, 2), x) == want


def test_links_across_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 16)
    monkeypatch.setattr(simhash, "SAMPLE", 200)
    x = _cloud(random.Random(9), 200, 5, 3)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    a, b = (np.array(c, np.int64).view(np.uint64) for c in zip(*((r.a, r.b) for r in simhash.links(df).collect()), strict=True))
    assert _clusters(len(x), a, b, x) == brute.components(x.tolist())


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_of_a_cloud_too_large_for_a_task(spark, monkeypatch, radius):
    """Shards beyond LARGE are searched by midpoints: the same components, true links only."""
    x = np.unique(np.concatenate([_cloud(random.Random(4), 1, 400, 4), _cloud(random.Random(5), 150, 3, 3)]))
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long").repartition(3)
    want = brute.components(x.tolist(), radius)
    for large in (30, 0):  # some shards, and all of them
        monkeypatch.setattr(simhash, "LARGE", large)
        rows = simhash.links(df, radius).collect()
        a, b = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in ("a", "b"))
        assert _clusters(len(x), a, b, x) == want
        assert large or (np.bitwise_count(a ^ b) <= radius).all()


def test_components_of_a_long_chain(spark):
    from prefpairs.llm.components import connected_components

    edges = [(k, k + 1) for k in range(60)] + [(100, 100), (200, 201), (201, 200), (203, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 200: 200, 201: 200, 203: 200}


# --- 8: languages ----------------------------------------------------------------------


def test_query_language(spark, documents):
    lang = {d["doc_id"]: d["lang"] for d in documents}
    rows = QUERIES["op8_language_id"](spark, SF001).collect()
    assert len(rows) == len(documents)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.accepted for r in held) >= 0.8 * len(held)


def test_language_of_texts_without_letters(spark, awkward):
    model = langid.fit(spark.read.parquet(f"{SF001}/documents.parquet"), ~langid.held_out())
    out = langid.identify(awkward.select("doc_id", "text"), model).collect()
    und = {r.id for r in out if r.lang_pred == "und"}
    assert {6, 7, 8, 9} <= und and 1 not in und and 10 not in und
    assert all(r.score == 0 and not r.accepted for r in out if r.lang_pred == "und")


def test_every_language_is_learned_alike_under_any_partitioning(spark):
    """150 languages of few texts each, one with a third of the rows, of which many share an id."""
    rng = random.Random(8)
    name = lambda k: f"l{k:03d}"
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = {name(k): ["".join(rng.choices(letters, k=6)) for _ in range(12)] for k in range(150)}
    rows = [(1000 * k + i, name(k), " ".join(rng.choices(vocabulary[name(k)], k=20))) for k in range(150) for i in range(14)]
    rows += [(7, name(0), " ".join(rng.choices(vocabulary[name(0)], k=20))) for _ in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    models = [langid.fit(docs.repartition(n), F.lit(True)) for n in (1, 5)]
    assert models[0].languages == sorted(vocabulary) and models[0].weights.shape == (langid.DIM, 150)
    assert np.array_equal(models[0].vectors, models[1].vectors) and np.array_equal(models[0].weights, models[1].weights)
    sizes = langid.SAMPLE // 150, langid.FEWEST
    assert max(sizes) == langid.FEWEST
    fresh = [(k, None, " ".join(rng.choices(vocabulary[name(k)], k=20))) for k in range(150)]
    out = langid.identify(spark.createDataFrame(fresh, "doc_id long, lang string, text string"), models[0]).collect()
    assert len(out) == 150 and all(0 <= r.score <= 1 for r in out)


def test_wide_and_narrow_models_agree():
    """Scores of buckets and embeddings with weights give the same probabilities."""
    rows = [("a", *langid.counts(b"le chat est la " * 30)), ("b", *langid.counts(b"the cat is here " * 30))] * 10
    model = langid.train(rows)
    wide = langid.Model(model.languages, model.vectors, np.eye(2, dtype=np.float32), model.bias, model.threshold)
    sums, n = np.array([[3.0, 1.0], [0.5, 2.0]]), np.array([2.0, 1.0])
    assert np.allclose(model.probabilities(sums, n), wide.probabilities(sums, n))


def test_language_scores_do_not_depend_on_blocks(monkeypatch):
    rows = [("a", *langid.counts(b"le chat est la " * 30)), ("b", *langid.counts(b"the cat is here " * 30))] * 10
    model = langid.train(rows)
    text = ("le chat est la bonne " * 200).encode()
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "BLOCK", 64)
    parts = langid.counts(text)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    assert model.languages == ["a", "b"] and langid.train([]) is None


def test_model_never_sees_held_out_rows(spark):
    """Held-out rows alone teach nothing."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").filter(langid.held_out())
    assert langid.fit(docs, ~langid.held_out()) is None
    out = langid.identify(docs, None).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in out] == [("und", 0.0)]
    assert docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).count() == 0
