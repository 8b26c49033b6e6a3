"""The text operators against the libraries and brute force, on awkward tables too."""

import hashlib
import json
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bytebpe, language, mixing, quality, queries, shards, tokenfiles, toxicity
from tidemark.llm.bytebpe import WordEncoder
from tidemark.llm.language import languages
from tidemark.llm.neardup import _block_links, _signatures, near_duplicates
from tidemark.llm.piecebpe import PrefixTable, encode_pieces
from tidemark.llm.quality import fit, quality_scores
from tidemark.llm.store import fresh_folder
from tidemark.llm.textcore import Words, shingles
from tidemark.llm.toxicity import ftrl, toxicity_scores

SMALL = "/root/testdata/sf0.001"
PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, component_id long, size long, score double, held_out boolean, key string"


def table(spark, rows):
    """Documents with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, lang, s, None, 1, 5, 6, 0.5, True, "k") for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    random.seed(3)
    word = lambda: "".join(random.choice("aeioutnsrhl") for _ in range(random.randint(1, 9)))
    long = " ".join(word() for _ in range(4000))
    base = [word() for _ in range(60)]
    near = base[:30] + ["changed"] + base[31:]
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", None), (4, long, "en", "a"), (5, long, "en", "b"), (6, " ".join(base), "en", "b"), (7, " ".join(near), "fr", "b"),
        (8, "  ".join(base).upper(), "de", None), (9, "one two", "en", "a"), (10, "ONE two", "en", "c"), (11, "one two three", None, "c"), (12, "é漢字🙂 <s> \0 12!!", "fr", "a"),
        (12, "é漢字🙂 <s> \0 12!!", "fr", "a"), (None, "no id here at all", "en", "a"), (-7, "12345 ### 99", "en", "z"), (13, "a\n\n  b \t c  <|endoftext|> it's", "en", "a"),
    ]
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def test_prefix_table_is_the_library():
    with open(PIECES, "rb") as f:
        t = PrefixTable(f.read())
    random.seed(1)
    pieces = [t.processor.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    for k in range(1500):
        s = "".join(random.choice("aeiou tnsrhl\n▁é漢🙂.,<>s/0 ") for _ in range(25)) if k % 2 else "".join(random.choice(pieces) for _ in range(6))
        assert np.frombuffer(t.encode(s), "<u4").tolist() == t.processor.encode(s, add_bos=True, add_eos=True), s


def test_pieces_of_awkward_texts(awkward, empty):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = Counter((r.doc_id, bytes(r.ids_le), r.decoded) for r in encode_pieces(awkward, PIECES).collect())
    wanted = Counter((i, np.array(ids := sp.encode(t, add_bos=True, add_eos=True), "<u4").tobytes(), sp.decode(ids)) for i, t in texts(awkward))
    assert found == wanted
    assert encode_pieces(empty, PIECES).count() == 0


def test_pieces_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = dict(texts(spark.read.parquet(f"{SMALL}/documents.parquet")))
    for r in queries.op1_sentencepiece(spark, SMALL).collect():
        ids = sp.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def shingle_sets(rows):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t.translate(low))
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    return sets


def brute_components(sets, links):
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def near_links(sets):
    ids = sorted(sets)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]


def test_near_duplicates(spark, awkward, empty):
    for docs in (awkward.where("doc_id is not null"), spark.read.parquet(f"{SMALL}/documents.parquet")):
        sets = shingle_sets(texts(docs))
        component = brute_components(sets, near_links(sets))
        rows = near_duplicates(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), component[r.doc_id], component[r.doc_id] == r.doc_id), r
    assert near_duplicates(empty).count() == 0
    assert [r.kept for r in near_duplicates(awkward).where("doc_id is null").collect()] == [False]


def test_near_duplicates_in_dense_groups(spark):
    """Hundreds of near copies of one text, and as many texts that share only a passage."""
    random.seed(5)
    word = lambda: "".join(random.choice(string.ascii_lowercase) for _ in range(6))
    base, passage = [word() for _ in range(300)], [word() for _ in range(40)]
    rows = []
    for i in range(250):
        one = list(base)
        for _ in range(random.randint(0, 6)):
            one[random.randrange(300)] = word()
        rows.append((i, " ".join(one), "en", "a"))
        rows.append((1000 + i, " ".join([word() for _ in range(60)] + passage), "en", "a"))
    sets = shingle_sets([(i, t) for i, t, _, _ in rows])
    component = brute_components(sets, near_links(sets))
    found = {r.doc_id: r.component_id for r in near_duplicates(table(spark, rows)).collect()}
    assert found == component


def family(n, linked=lambda a, b: True):
    """n texts that share 86 of 100 shingles, and two amid them, at a third and two thirds of the ids, that share 93 and are the only link."""
    word = lambda: "".join(random.choice(string.ascii_lowercase) for _ in range(6))
    base = [word() for _ in range(97)]
    rows = {i: " ".join(base[:90] + [word() for _ in range(14)]) for i in range(n)}
    a, b = n // 3, 2 * n // 3
    while True:
        rows[a], rows[b] = (" ".join(base + [word() for _ in range(7)]) for _ in range(2))
        if linked(rows[a], rows[b]):
            return rows, {i: a if i == b else i for i in rows}


def components_of(spark, rows):
    return {r.doc_id: r.component_id for r in near_duplicates(table(spark, [(i, t, "en", "a") for i, t in rows.items()])).collect()}


def test_near_duplicates_far_apart_in_a_large_family(spark):
    """The link's rows are over 512 places apart in all orders."""
    random.seed(11)
    rows, wanted = family(6000)
    assert components_of(spark, rows) == wanted


def test_near_duplicates_just_above_the_limit_in_a_large_family(spark):
    """The link's signatures agree in less than 0.77 of their minhashes."""
    random.seed(12)

    def linked(a, b):
        x, y = (_signatures(*shingles(Words([t])))[0] for t in (a, b))
        return (x == y).mean() < 0.77

    rows, wanted = family(700, linked)
    assert components_of(spark, rows) == wanted


def test_block_links():
    """Against brute force, for sets about the limit and of several sizes, within a block and between two."""
    rng = np.random.default_rng(4)
    for turn in range(30):
        base = rng.choice(1000, 120, replace=False)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(60, 121), replace=False) if turn % 2 else rng.permutation(base)[rng.integers(0, 15) :], rng.choice(5000, rng.integers(0, 12)) + 1000])) for _ in range(60)]
        first, comps = (0, 25)[turn % 3 > 0], np.where(rng.random(60) < 0.2, 0, np.arange(60))
        found = _block_links(np.concatenate(sets).astype(np.uint64), np.array([len(s) for s in sets]), comps, first, 85)
        kept = {k: set(s.tolist()) for k, s in enumerate(sets)}
        links = [(a, b) for a, b in near_links(kept) if not first or (a < first) != (b < first)]
        assert all((a, b) in {(comps[x], comps[y]) for x, y in links} for a, b in found)
        nodes = dict.fromkeys(comps.tolist())
        assert brute_components(nodes, [(int(comps[a]), int(comps[b])) for a, b in links]) == brute_components(nodes, found)


def test_near_duplicates_in_many_small_partitions(spark):
    """Regions that run over many partitions of a few rows each."""
    random.seed(13)
    rows, wanted = family(150)
    groups = {1000 * g + i: f"{' '.join(f'g{g}w{k}' for k in range(90))} {' '.join(f'g{g}i{i}w{k}' for k in range(1, 8 if i in (3, 11) else 16))}" for g in range(1, 4) for i in range(14)}
    rows |= groups
    wanted |= {i: i - 8 if i % 1000 == 11 else i for i in groups}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        assert components_of(spark, rows) == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_packed_ids_round_trip():
    random.seed(2)
    values = np.array([random.choice([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1]) for _ in range(4000)], np.uint32)
    control, data = tokenfiles.pack(values)
    assert len(control) == 1000
    assert (tokenfiles.unpack(control, data) == values).all()
    assert len(tokenfiles.unpack(*tokenfiles.pack(values[:0]))) == 0


def byte_ids(rows):
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    return [(i, t.encode(x, add_special_tokens=False).ids) for i, x in rows]


def test_token_files(spark, awkward, empty):
    for docs in (awkward, spark.read.parquet(f"{SMALL}/documents.parquet")):
        folder = fresh_folder(spark, "test-token-files")
        manifest = tokenfiles.write_token_files(docs, BYTES, 2, folder)
        rows = tokenfiles.with_crc(tokenfiles.read_token_files(manifest, folder)).orderBy("start").collect()
        wanted = byte_ids(sorted(texts(docs), key=lambda x: (x[0] is not None, x[0])))
        start = 0
        for r, (i, ids) in zip(rows, wanted, strict=True):
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
            start += len(ids) + 1
    folder = fresh_folder(spark, "test-token-files")
    assert tokenfiles.read_token_files(tokenfiles.write_token_files(empty, BYTES, 2, folder), folder).count() == 0


def test_token_files_query_is_the_plain_library(spark, tmp_path):
    """Added tokens that a text holds literally, in the query's own output."""
    rows = [(1, "a <|endoftext|> b", "en", "a"), (2, "plain text, twice", "en", "a"), (3, "<|endoftext|><|endoftext|>", "en", "a"), (4, None, "en", "a"), (5, "a <|endoftext b", "en", "a")]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    t, start = Tokenizer.from_file(BYTES), 0
    for r, (i, text, _, _) in zip(queries.op5_token_files(spark, str(tmp_path)).orderBy("start").collect(), rows, strict=True):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_separator_scan(spark, awkward, empty):
    folder = fresh_folder(spark, "test-flat")
    written = {(r.shard, r.ordinal): r.doc_id for r in tokenfiles.write_flat_files(awkward, BYTES, 50256, folder).collect()}
    wanted = Counter((i, len(ids)) for i, ids in byte_ids(texts(awkward)))
    for block in (6, 64, 1 << 20):
        rows = tokenfiles.scan_separators(spark, folder, 50256, block_bytes=block).collect()
        assert Counter((written[r.shard, r.ordinal], r.n_tokens) for r in rows) == wanted
        assert all(r.ended for r in rows)
    found = tokenfiles.scan_separators(spark, folder, 64, block_bytes=10).collect()
    assert not all(r.ended for r in found)
    folder = fresh_folder(spark, "test-flat")
    tokenfiles.write_flat_files(empty, BYTES, 50256, folder)
    assert tokenfiles.scan_separators(spark, folder, 50256).count() == 0


def test_token_counts_query(spark):
    wanted = {i: len(ids) for i, ids in byte_ids(texts(spark.read.parquet(f"{SMALL}/documents.parquet")))}
    assert {r.doc_id: r.n_tokens for r in queries.op8_token_counts(spark, SMALL).collect()} == wanted


def test_words_around_rare_white_space_are_the_librarys():
    """Cuts around every kind of white space give what the library gives for the whole text, and nothing long is remembered."""
    random.seed(5)
    t = Tokenizer.from_file(BYTES)
    with open(BYTES, encoding="utf-8") as f:
        e = WordEncoder(f.read(), True)
    kinds = "ab c \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u200b\u2028\u2029\u202f\u205f\u3000\ufeff\u00e91'!.,\u6f22\0"
    for _ in range(20_000):
        said = "".join(random.choice(kinds) for _ in range(random.randint(1, 14)))
        assert np.frombuffer(e.encode([said])[0], e.dtype).tolist() == t.encode(said, add_special_tokens=False).ids, repr(said)
    e.words.clear()
    long = "\u6f22" * 200_000
    assert np.frombuffer(e.encode([long])[0], e.dtype).tolist() == t.encode(long, add_special_tokens=False).ids
    e.encode([f"word{i} and\xa0blank" + " x" * 1000 for i in range(5)])
    assert max(map(len, e.words)) <= 64


def test_words_are_put_together_from_units():
    """A word with signs or a line feed costs the library nothing once its units are known, and gives what the library gives for the whole text."""
    t = Tokenizer.from_file(BYTES)
    with open(BYTES, encoding="utf-8") as f:
        e = WordEncoder(f.read(), True)
    check = lambda said: np.frombuffer(e.encode([said])[0], e.dtype).tolist() == t.encode(said, add_special_tokens=False).ids
    assert check("brandel brandel, wört wört. ende*** ende") and check("a.*** b,") and check("\nende wört,")
    e.tokenize = e.tokenizer = None
    assert check(" brandel. wört***\nende, wört, ende.*** brandel***")
    with open(BYTES, encoding="utf-8") as f:
        e = WordEncoder(f.read(), True)
    random.seed(6)
    for _ in range(20_000):
        said = "".join(random.choice("abE \n.,*$_-~`<|'²ªö€ƀɐ7") for _ in range(random.randint(1, 10)))
        assert check(said), repr(said)


def test_remembered_words_take_bounded_room(monkeypatch):
    monkeypatch.setattr(bytebpe, "ROOM", 50_000)
    kept = bytebpe.Remembered(lambda w: w.encode())
    assert all(kept[str(i)] == str(i).encode() for i in range(5000))
    assert len(kept) < 250 and len(kept["y" * 65]) == 65 and "y" * 65 not in kept


def test_remembered_words_that_are_met_again_stay(monkeypatch):
    monkeypatch.setattr(bytebpe, "ROOM", 50_000)
    learned = Counter()
    kept = bytebpe.Remembered(lambda w: learned.update([w]) or w.encode())
    for i in range(5000):
        assert kept["often"] == b"often" and kept.many([str(i), "always"]) == [str(i).encode(), b"always"]
    assert learned["often"] == learned["always"] == 1 and len(kept) + len(kept.older) < 250


def test_units_of_many_texts_are_looked_up_once(monkeypatch):
    """Slices of a column with nulls, empty texts and added tokens give what the library gives for each text; what is looked up in Python are different units only."""
    t = Tokenizer.from_file(BYTES)
    with open(BYTES, encoding="utf-8") as f:
        e = WordEncoder(f.read(), True)
    looked, many = [], e.words.many
    monkeypatch.setattr(e.words, "many", lambda words: looked.append(len(words)) or many(words))
    assert len(set(e.encode(["one two, one. two\none"] * 500))) == 1 and looked == [6]
    random.seed(11)
    parts = [*"ab \n\t\xa0\u2009\u3000\x85\u201d\u00e9\u00d7.,'1\u6f22", " the", "it's.", "\n", "<|endoftext|>", "<|endof", "text|>"]
    texts = [None if k % 17 == 0 else "".join(random.choices(parts, k=random.randint(0, 12))) for k in range(4000)]
    wanted = [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], e.dtype).tobytes() for x in texts]
    for size, stride in ((1, 7), (1000, 16), (1 << 20, 1 << 18)):
        monkeypatch.setattr(bytebpe, "SLICE", size)
        monkeypatch.setattr(bytebpe, "STRIDE", stride)
        column = pa.array(texts, pa.string())
        assert [x for lo, n in bytebpe.slices(column) for x in e.encode_array(column.slice(lo, n), e.ids([2])).to_pylist()] == wanted


def test_added_tokens_of_letters_or_signs_are_the_librarys():
    with open(BYTES, encoding="utf-8") as f:
        said = json.load(f)
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
    said["added_tokens"] += [{"id": 50257 + k, "content": c, "special": c == "***", **plain} for k, c in enumerate(("brandel", "***"))]
    spec = json.dumps(said)
    for added in (True, False):
        t, e = Tokenizer.from_str(spec), WordEncoder(spec, added)
        t.encode_special_tokens = not added
        for x in ("brandel", " brandel", "***", "a*** brandels", "plain, text", "brandel <|endoftext|>"):
            assert np.frombuffer(e.encode([x])[0], e.dtype).tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_token_files_are_the_same_when_written_again(spark):
    """Rows with one doc_id or without, in another input order: byte-identical shards."""
    rows = [(i % 3 if i % 4 else None, f"text number {i * 7 % 50}", "en", "a") for i in range(200)]
    contents = []
    for some in (rows, rows[::-1]):
        folder = fresh_folder(spark, "test-token-files")
        tokenfiles.write_token_files(table(spark, some).repartition(3), BYTES, 2, folder).count()
        contents.append({n: shards.read_range(folder, n, 0, size) for n, size in shards.sizes(folder, ".tids")})
    assert contents[0] == contents[1] and contents[0]


def test_ftrl_is_the_plain_rule():
    """Against dictionaries and one coordinate at a time."""
    random.seed(9)
    examples = [(np.unique(np.array([*([7] if y else [9]), *random.sample(range(10, 40), 6)], np.int32)), y) for y in (0, 1) * 40]
    z, n = Counter(), Counter()

    def weight(k):
        if abs(z[k]) <= toxicity.L1:
            return 0.0
        return -(z[k] - math.copysign(toxicity.L1, z[k])) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.PASSES):
        for own, y in examples:
            at = [*own.tolist(), "bias"]
            w = {k: weight(k) for k in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for k in at:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * w[k]
                n[k] += g * g
    found, bias = ftrl(examples, 40)
    assert abs(bias - weight("bias")) < 1e-9 and all(abs(found[k] - weight(k)) < 1e-9 for k in range(40)) and any(found)


def test_toxicity_scores_by_brute_force(spark):
    """The whole query on a small table: each text's features apart, learned in the order of the stored sample."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    order = {r.doc_id: r.o for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(9)).alias("o")).collect()}
    said = {i: np.unique(toxicity.features([t])[0]) for i, t in texts(docs)}
    marked = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.doc_id in said}
    w, bias = ftrl([(said[i], marked[i]) for i in sorted(marked, key=lambda i: (order[i], i))])
    for r in toxicity_scores(docs, labels).collect():
        total = sum(np.float32(w[b]) for b in said[r.doc_id]) + bias
        assert abs(r.score - 1 / (1 + math.exp(-max(-35, min(35, total))))) < 1e-5, r


def test_language_fit_is_kernel_ridge_regression():
    """Folded weights against kernels of sets, the landmarks' inverse root and the ridge's normal equations."""
    rng = np.random.default_rng(2)
    examples = [(np.unique(rng.choice(np.arange(k * 40, k * 40 + 120), 30)).astype(np.int32), "abc"[k]) for k in (0, 1, 2) * 30]
    marks = [g for c in "abc" for g in [g for g, y in examples if y == c][: language.LANDMARKS // 3]]
    kernel = lambda x, y: len(set(x.tolist()) & set(y.tolist())) / math.sqrt(len(x) * len(y))
    k = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, axes = np.linalg.eigh(k)
    good = values > 1e-8 * values[-1]
    x = np.array([[kernel(g, m) for m in marks] for g, _ in examples]) @ (axes[:, good] / np.sqrt(values[good]))
    y = np.array([[1.0 if c == own else -1.0 for c in "abc"] for _, own in examples])
    wanted = x @ np.linalg.solve(x.T @ x + language.RIDGE * np.eye(x.shape[1]), x.T @ y)
    known, weights = language.fit(examples, list("abc"))
    at = {int(g): i for i, g in enumerate(known)}
    found = np.array([sum(weights[at[int(g)]] for g in own) / math.sqrt(len(own)) for own, _ in examples])
    assert np.abs(found - wanted).max() < 2e-3 and (found.argmax(1) == y.argmax(1)).mean() > 0.95


def test_languages_of_other_scripts(spark):
    """Two languages in Cyrillic letters and two in Arabic ones, and very many empty texts."""
    random.seed(3)
    words = {"ru": "что это как они было все время человек который сказал очень город ещё первый", "uk": "що це як вони було всі час людина який сказав дуже місто ще перший", "fa": "این است که را با از برای یک خود می کند گفت پس چه", "ar": "هذا هو الذي في على من إلى كان وقد قال أن كل بعد ما"}
    rows = [(i, " ".join(random.choice(words[lang].split()) for _ in range(25)), lang, "s") for i, lang in enumerate(list(words) * 60)]
    blank = [(1000 + i, "", "ru", "s") for i in range(5000)]
    got = {r.doc_id: r for r in languages(table(spark, rows + blank)).collect()}
    held = [(r[2], got[r[0]].lang_pred) for r in rows if got[r[0]].held_out]
    assert len(held) > 20 and np.mean([a == b for a, b in held]) > 0.95
    assert all(got[i].lang_pred == "und" for i, _, _, _ in blank)


def test_positive_unlabelled_risk_is_least():
    """A plain sum of losses over rows: no small step from the fitted weights lowers it."""
    rng = np.random.default_rng(5)
    p, u, prior = rng.normal(0, 1, (200, 3)), np.concatenate([rng.normal(0, 1, (200, 3)), rng.normal(3, 1, (150, 3))]), 0.55
    low, high, w = fit(p, u, prior)
    loss = lambda t: math.log1p(math.exp(-t)) if t > -35 else -t

    def risk(w):
        gp, gu = (quality._expanded(x, low, high) @ w for x in (p, u))
        toward = prior * sum(loss(t) for t in gp) / len(gp)
        against = sum(loss(-t) for t in gu) / len(gu) - prior * sum(loss(-t) for t in gp) / len(gp)
        return toward + max(0.0, against) + quality.DECAY / 2 * float(w @ w)

    least = risk(w)
    assert least < risk(np.zeros_like(w)) and all(risk(w + rng.normal(0, 0.05, len(w))) > least - 1e-3 for _ in range(60))


def test_prior_from_positives_and_unlabelled(spark):
    rng = np.random.default_rng(6)
    p = rng.normal(0, 1, (3000, 4))
    u = np.concatenate([rng.normal(0, 1, (2000, 4)), rng.normal(6, 1, (2000, 4))])
    assert abs(quality.estimated_prior(p, u) - 0.5) < 0.07
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    assert quality_scores(docs, labels.where("quality = 1")).where("score between 0 and 1").count() == docs.count()


def test_near_duplicates_of_repeated_ids(spark):
    """Different texts under one doc_id link what each of them is linked with, in one partition and in many."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(5, a), (5, b), (3, b), (7, a), (9, "alone here"), (None, a)]
    for width in (1, 40):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        try:
            spark.conf.set("spark.sql.shuffle.partitions", width)
            got = sorted((r.doc_id or 0, r.component_id) for r in near_duplicates(table(spark, [(i, t, "en", "a") for i, t in rows])).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert got == [(0, 3), (3, 3), (5, 3), (5, 3), (7, 3), (9, 9)]


def test_ftrl_learns_and_is_sparse():
    random.seed(4)
    examples = [(np.unique(np.array([7 if y else 9, *random.sample(range(100, 5000), 30)], np.int32)), y) for y in (0, 1) * 400]
    w, _ = ftrl(examples, 5000)
    assert w[7] > 1 and w[7] > w[9] and (w != 0).sum() < 500


def test_positive_unlabelled_fit():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (900, 4)), rng.normal(5, 1, (300, 4))
    from tidemark.llm.quality import _expanded

    low, high, w = fit(good[:300], np.concatenate([good[300:], bad]), 600 / 900)
    score = lambda x: 1 / (1 + np.exp(-_expanded(x, low, high) @ w))
    assert (score(good) > 0.5).mean() > 0.95 and (score(bad) < 0.5).mean() > 0.95


@pytest.mark.parametrize("scorer,label,least", [(toxicity_scores, "toxic", 0.75), (quality_scores, "quality", 0.9)])
def test_scores(spark, awkward, empty, scorer, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = scorer(docs, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    one, zero = ([r.score for r in held if r[label] == y] for y in (1, 0))
    auc = np.mean([(a > b) + (a == b) / 2 for a in one for b in zero])
    assert auc >= least
    few = labels.where("doc_id < 0")
    assert scorer(awkward, labels).count() == awkward.count()
    assert scorer(awkward, few).where("score between 0 and 1").count() == awkward.count()
    assert scorer(empty, few).count() == 0
    kept = scorer(awkward, few, keep=["text", "score"]).where("doc_id = 9").first()
    assert (kept.kept_text, kept.kept_score) == ("one two", 0.5)


def test_languages(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    got = languages(awkward).collect()
    assert len(got) == awkward.count()
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (1, 2, 3, -7)} == {1: "und", 2: "und", 3: "und", -7: "und"}
    assert all(0 <= r.score <= 1 for r in got)
    assert languages(empty).count() == 0


def test_mixing(spark, awkward, empty):
    planned = mixing.plan(awkward).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter(r.size for r in planned) == Counter(size(t) for _, t in texts(awkward))
    total = Counter()
    for r in planned:
        total[r.source] += r.taken
        assert r.taken <= 2 * r.size
    targets = {r.source: (r.target, r.source_size) for r in planned}
    assert all(abs(total[s] - t) <= 1 and t <= 2 * n for s, (t, n) in targets.items())
    assert abs(sum(t for t, _ in targets.values()) - 1.5 * sum(n for _, n in targets.values())) < 1e-6
    assert sorted(map(str, planned)) == sorted(map(str, mixing.plan(awkward.repartition(3)).collect()))
    assert mixing.plan(empty).count() == 0
    order = [r.position for r in mixing.training_order(mixing.plan(awkward)).collect()]
    assert order == sorted(order)
    whole = mixing.plan(awkward, whole=True, keep=["text", "size"]).collect()
    assert all(p.words == r.size for r in whole for p in r.placements) and all(r.kept_size == 6 for r in whole)


def test_mixing_matches_sql(spark, duck):
    from conftest import as_rows

    df = queries.op9_mixing(spark, SMALL)
    columns = sorted(df.columns)
    assert as_rows(tuple(r[c] for c in columns) for r in df.collect()) == as_rows(duck.sql(queries.SQL["op9_mixing"]).project(", ".join(columns)).fetchall())


def test_filter_audit_by_brute_force(spark, awkward, empty):
    """Every order and step by going through the filters one after the other, on awkward rows too."""
    from itertools import permutations

    from tidemark.llm.filteraudit import filter_audit

    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (5, 0, 0), (6, 1, None), (12, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    known = {4: (1, 1), 5: (0, 0), 6: (1, 0), 12: (0, 1)}
    more = awkward.union(table(spark, [(20, "", None, "a"), (21, "A#" * 9, None, None), (22, "w " * 300, None, "a")]))
    docs = [(r.doc_id, r.text or "", r.source or "") for r in more.collect()]

    def fails(i, t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        marks = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        return {k for k, v in marks.items() if v} | ({"E"} if i is not None and any(j is not None and j < i and u == t for j, u, _ in docs) else set())

    wanted = {}
    for part in {p for _, _, p in docs}:
        own = [(fails(i, t), *known.get(i, (0, 0))) for i, t, p in docs if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for k, f in enumerate(order):
                out = [r for r in left if f in r[0]]
                failing = sum(f in r[0] for r in own)
                left = [r for r in left if f not in r[0]]
                wanted[part, order, k + 1] = [len(left), len(out), failing - len(out), sum(r[0] == {f} for r in own), sum(r[1] for r in out), sum(r[2] for r in out)]
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                wanted[part, order, k + 1].append(sum(wanted[part, o, o.index(f) + 1][1] for o in map("".join, permutations("ABCDE"))))
    found = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in filter_audit(more, labels).collect()}
    assert found == wanted
    assert filter_audit(empty, labels).count() == 0


def test_samples_of_repeated_ids(spark, monkeypatch):
    """Rows that share one doc_id are drawn each for itself: bounds hold, and there is something to learn from."""
    from tidemark.llm import sampling

    monkeypatch.setattr(language, "MOST", 200)
    monkeypatch.setattr(toxicity, "MOST", 100)
    monkeypatch.setattr(quality, "MOST", 100)
    english, german = "the house and the tree", "der Baum und das Haus"
    for one_id in (1, 3, 7):
        docs = table(spark, [(one_id, f"{english if i % 2 else german} {i}", "en" if i % 2 else "de", "a") for i in range(3000)])
        own = spark.createDataFrame([(one_id, 1)], "doc_id long, toxic int")
        rows, counts = sampling.labelled(docs, own, "toxic", 100, 3)
        assert counts in ({1: 3000}, {}) and rows.count() <= 160 and (rows.count() > 50) == bool(counts)
        learned, classes = language.language_model(docs)
        assert classes == (["de", "en"] if zlib.crc32(str(one_id).encode()) % 5 else [])
        if classes:
            preds = languages(docs, keep=["lang"]).collect()
            assert all(r.lang_pred == r.kept_lang for r in preds)
        drawn = docs.sparkSession.createDataFrame([(one_id, 1)], "doc_id long, quality int")
        assert quality_scores(docs, drawn).count() == 3000
