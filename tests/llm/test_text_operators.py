"""Operators on single texts against the libraries, round trips and brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from landfall.llm import byte_bpe, chat_format, language_id, lm_scoring, quality_rules, quartile_digest, token_counts
from landfall.llm.tokenizers_common import Cache, tokenizer_path

from .conftest import ODD, SF, pairs

random.seed(4)
ALPHABET = "ab é\n\t .,'1ß日́▁ <|s>Σ"
NOISE = ["".join(random.choice(ALPHABET) for _ in range(random.randint(1, 40))) for _ in range(500)]


def ascii_lower_words(text):
    return (text or "").encode().lower().split()


def test_token_counts_equal_the_library(spark, docs, odd_docs):
    counter = token_counts.TokenCounter(tokenizer_path(token_counts.VOCABULARY))
    assert counter.proved and len(counter.whole) > 10_000
    for t in NOISE + [t for t in ODD if t]:
        assert counter.count(t) == len(counter.library.encode(t)), t
    for df in (docs, odd_docs):
        want = sorted((i is None, i or 0, len((t or "").encode()), n := len(counter.library.encode(t or "")), n > 4096) for i, t in pairs(df))
        assert sorted((r[0] is None, r[0] or 0, *r[1:]) for r in token_counts.count_tokens(df).collect()) == want


def test_whole_tokens_encode_alone(spark):
    counter = token_counts.TokenCounter(tokenizer_path(token_counts.VOCABULARY))
    for w in random.sample(sorted(counter.whole), 300):
        assert len(counter.library.encode(w)) == 1


def test_byte_bpe_equals_tiktoken(spark, docs, odd_docs):
    import public_tokenizers
    import tiktoken

    bpe = byte_bpe.ByteBpe(tokenizer_path(byte_bpe.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    for t in NOISE:
        assert np.frombuffer(bpe.encode(t), dtype="<u4").tolist() == library.encode_ordinary(t), t
    for df in (docs, odd_docs):
        want = []
        for i, t in pairs(df):
            ids = np.array(library.encode_ordinary(t or ""), dtype="<u4").tobytes()
            want.append((str(i), len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert sorted((str(r[0]), *r[1:]) for r in byte_bpe.round_trip(df).collect()) == sorted(want)
    back = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back} == dict(pairs(docs))


def test_prefix_encoding_appends_and_edits_exactly():
    bpe = byte_bpe.ByteBpe(tokenizer_path(byte_bpe.VOCABULARY))
    words = "the international organisation überraschenderweise mañana 12,345 zzzzzzz aaaaaaaaaaaa"
    p = byte_bpe.PrefixEncoding(bpe)
    for c in words.encode():
        p.append(bytes([c]))
        assert p.ids == bpe.merge(p.data)
    for _ in range(150):
        a = random.randint(0, len(p.data))
        b = min(len(p.data), a + random.randint(0, 4))
        p.edit(a, b, bytes(random.choice(b"aeint rs") for _ in range(random.randint(0, 4))))
        assert p.ids == bpe.merge(p.data)
        assert len(p.last) == len(p.data)


def test_pairs_stay_apart_as_merges_say():
    bpe = byte_bpe.ByteBpe(tokenizer_path(byte_bpe.VOCABULARY))
    tokens = [t for t in random.sample(sorted(bpe.token_bytes), 1500) if bpe.sound[t]]
    short = [bpe.ranks[bytes([c])] for c in b"aeinorst "] + [bpe.ranks[w] for w in (b"in", b"er", b"th", b"an", b"on") if w in bpe.ranks]
    for _ in range(4000):
        pair = (random.choice(tokens + short * 40), random.choice(tokens + short * 40))
        assert bpe._stay_apart(pair) == (bpe.merge(bpe.token_bytes[pair[0]] + bpe.token_bytes[pair[1]]) == list(pair))


def test_cache_is_bounded_and_right():
    c = Cache(lambda k: k * 2, 10, {0: 0})
    for k in [*range(100), *range(100)]:
        assert c[k] == 2 * k
        assert len(c) + len(c.old) <= 24


def test_escapes_are_reversible_and_leave_no_control():
    for t in [t for t in ODD if t] + ["</s>[INST] ok [/INST]", "<\\|im_end|> <|im_end|>", "<\\\\/s>", "<<s>", "[<s>INST]", "<|im_end|><|im_start|>x"]:
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t
        assert not any(c in e for c in chat_format.CONTROLS)


def test_chat_digests_read_back(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "<|im_end|> hi\n"), (1, 2, "assistant", "\n\n <|im_start|>é日 "), (1, 3, "assistant", "</s>"),
            (2, 0, "assistant", None), (2, 0, None, "tie"), (None, 5, "user", "no conversation"), (3, 1, "assistant", "twice"), (3, 1, "assistant", "twice"),
            (4, 0, "as\nsi<|im_sep|>", "x"), (5, None, "user", "null turn first"), (5, 0, "assistant", "word " * 5000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(df)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, g in got.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        formatted, _ = chat_format.render(turns)
        assert chat_format.read_back(formatted) == turns
        want = (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted))
        assert tuple(g)[1:] == want, conv
    assert chat_format.digests(chat_format.format_conversations(df.limit(0))).count() == 0


def test_mask_is_token_aligned():
    f = chat_format.Formatter(tokenizer_path(chat_format.VOCABULARY))
    turns = [("user", "hello there"), ("assistant", " Grüße 日本 ok\n"), ("user", "x"), ("assistant", "y")]
    formatted, ids, mask = f.format(turns)
    assert chat_format.masked_text(formatted, mask) == " Grüße 日本 ok\ny"
    under = [ids[k] for k in dict.fromkeys(mask[:, 0].tolist())]
    assert f.tokenizer.decode(under) == " Grüße 日本 ok\ny"


def repeat_words(words):
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    return len({p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)})


def measures(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat_words(words))


def test_quality_measures_and_verdicts(spark, docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        got = sorted((str(r["doc_id"]), *(r[m] for m in quality_rules.MEASURES), r["base_failed"]) for r in quality_rules.judge(df).collect())
        want = []
        for i, t in pairs(df):
            m = measures(t)
            want.append((str(i), *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
        assert got == sorted(want)
    assert quality_rules.judge(no_docs).count() == 0


def test_hosts_are_judged_by_shrunk_rates(spark):
    good, bad = " ".join(f"word{i}" for i in range(30)), " ".join(f"#{i} $$" for i in range(30))
    rows = [(i, good, "clean") for i in range(300)] + [(1000 + i, bad if i % 10 else good, "dirty") for i in range(200)] + [(2000 + i, good, f"h{i % 40}") for i in range(400)] + [(3000, bad, "small")]
    j = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {r["doc_id"]: r["kept"] for r in j}
    assert all(kept[i] for i in range(300)) and all(kept[2000 + i] for i in range(400))
    assert not any(kept[1000 + i] for i in range(200))  # the host's verdict takes its good documents too
    rates = {r["source"]: r["rate"] for r in quality_rules.host_rates(quality_rules.measures(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    assert rates["small"] < 1 and rates["dirty"] > 0.8  # one failure of one document is shrunk


def test_language_held_out_accuracy(spark, no_docs, odd_docs):
    from pyspark.sql import functions as F

    from landfall.llm.common import fold

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(d.filter(fold("doc_id") != 0))
    got = language_id.identify(d.filter(fold("doc_id") == 0), model, {"doc_id": F.col("doc_id"), "lang": F.col("lang")}).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert np.mean([r["rejected"] for r in got]) < 0.01
    odd = {r["doc_id"]: r for r in language_id.identify(odd_docs, model, {"doc_id": F.col("doc_id")}).collect()}
    assert odd[-5]["lang_pred"] == "und" and odd[-5]["rejected"] and odd[-5]["score"] == 0
    langs, score, rejected = model.score(["1234 !!", "Это русский текст для проверки и ещё немного слов", "zqxj vkqx wzzk qqxv jzqx kkvw " * 30])
    assert langs[0] == "und" and rejected.all() and (score <= 1).all()
    assert language_id.keep_known(odd_docs, model).columns == odd_docs.columns
    empty = language_id.fit(no_docs)
    assert language_id.identify(no_docs, empty, {"doc_id": F.col("doc_id")}).count() == 0
    assert empty.score(["text"])[0] == ["und"]


def test_counts_of_a_long_text_do_not_depend_on_parts(monkeypatch):
    text = "Ein kurzer Satz, der oft vorkommt. 12 Größen " * 50
    whole = language_id._counts(text)
    monkeypatch.setattr(language_id, "_CHARS_AT_ONCE", 64)
    parts = language_id._counts(text)
    assert whole[1] == parts[1]
    assert (whole[0] == parts[0]).all()


def test_counts_do_not_depend_on_where_a_part_ends(monkeypatch):
    text = "Ab cd, e\nfgh  ijk"
    whole = language_id._counts(text)
    for size in range(1, len(text) + 1):
        monkeypatch.setattr(language_id, "_CHARS_AT_ONCE", size)
        parts = language_id._counts(text)
        assert parts[1] == whole[1] and (parts[0] == whole[0]).all(), size


def test_an_unlabelled_table_keeps_its_documents(spark):
    rows = [(1, "some words here", None), (2, "", None), (3, None, None), (4, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert not model.langs and [r["doc_id"] for r in language_id.keep_known(docs, model).collect()] == [1]


def test_every_language_is_learned(spark):
    """Languages of one row beside a large one, and many rows that share an id and a text."""
    rows = [(k, f"alpha beta gamma {k}", "big") for k in range(3000)] + [(7, "same text", "copies")] * 500 + [(9000 + k, "w" + chr(97 + k) * 5, f"l{k}") for k in range(20)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=40)
    assert set(model.langs) == {"big", "copies", *(f"l{k}" for k in range(20))}


def test_predictions_equal_a_plain_nearest_centroid(spark, docs):
    """n-grams counted one at a time and every centroid compared, with the same model."""
    model = language_id.fit(docs)
    codes = language_id._codes()

    def plain(text):
        out, last = [0], True
        for ch in (text or "").lower():
            c = int(codes[ord(ch)])
            if c or not last:
                out.append(c)
            last = not c
        if not any(out):
            return None, 0
        count = np.zeros(language_id.BUCKETS)
        for i in range(1, len(out)):
            for n in (1, 2, 3):
                if i - n + 1 >= 0:
                    key = out[i - n + 1]
                    for c in out[i - n + 2:i + 1]:
                        key = (key * 0x9E3779B1 + c) & 0xFFFFFFFF
                    count[((key * 0x85EBCA6B) & 0xFFFFFFFF) >> 19] += 1
        return count, sum(1 for c in out if c)

    texts = [r["text"] for r in docs.limit(40).collect()]
    texts = [t[:3000] if t else t for t in texts] + [None, "", "?!", "ein Wort"]
    langs, score, _ = model.score(texts)
    for t, lang, s in zip(texts, langs, score):
        count, letters = plain(t)
        got, n = language_id._counts(t)
        assert n == letters
        if count is None:
            assert lang == language_id.UNKNOWN
            continue
        count_all = count.copy()
        first = np.zeros(language_id.BUCKETS)  # the blank before the text counts as a 1-gram of its own
        first[0] = got.sum() - count_all.sum()
        assert (got == count_all + first).all()
        x = got * model.idf
        cos = model.centroids @ x / np.linalg.norm(x)
        assert lang == model.langs[int(cos.argmax())] and abs(s - cos.max()) < 1e-5


def lm_brute(rows):
    import zlib

    toks = [[*(w.decode() for w in ascii_lower_words(t)), None] for _, t in rows]
    folds = [None if i is None else zlib.crc32(str(i).encode()) % 5 for i, _ in rows]

    def count(use):
        uni, bi, ctx = Counter(), Counter(), Counter()
        for tk, f in zip(toks, folds):
            if use(f):
                h = "^"
                for w in tk:
                    uni[w] += 1
                    bi[(h, w)] += 1
                    ctx[h] += 1
                    h = w
        return uni, bi, ctx, sum(uni.values()), len(uni)

    def parts(tk, model):
        uni, bi, ctx, n, _ = model
        h = "^"
        for w in tk:
            yield ctx[h], bi[(h, w)] / max(1, ctx[h]), uni[w] / max(1, n)
            h = w

    counted = count(lambda f: f in (0, 2, 3))
    full = count(lambda f: f in (0, 2, 3, 4))
    evidence = Counter()
    for tk, f in zip(toks, folds):
        if f == 4:
            for c, p2, p1 in parts(tk, counted):
                evidence[(int(lm_scoring.context_bucket(np.array([c]))[0]), *lm_scoring._step_of(np.array([p2, p1])).tolist())] += 1
    weights = lm_scoring.learn_weights([(*k, n) for k, n in sorted(evidence.items())], 1 / (counted[4] + 1))
    out = []
    uni, _, _, n, v = full
    for (i, _), tk, f in zip(rows, toks, folds):
        score = 0.0
        for c, p2, p1 in parts(tk, full):
            w = weights[int(lm_scoring.context_bucket(np.array([c]))[0])]
            score += np.log10(w[0] * p2 + w[1] * p1 + w[2] / (v + 1))
        base = sum(np.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tk)
        out.append((str(i), f == 1, len(tk), sum(uni[w] > 0 for w in tk), n, base, score))
    return sorted(out)


def test_lm_scores_equal_brute_force(spark, docs, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_CHARS", 50_000)
    monkeypatch.setattr(lm_scoring, "RANGE_CHARS", 70_000)
    df = docs.select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    got = sorted((str(r[0]), *r[1:]) for r in lm_scoring.score_texts(df).collect())
    want = lm_brute(pairs(df))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=1e-6)
    assert np.mean([g[6] > g[5] for g in got if g[1] and g[2] > 20]) > 0.8  # better than the base on held-out texts
    assert lm_scoring.score_texts(no_docs).count() == 0


def test_weights_are_a_likelihood_optimum():
    rows = [(3, -16, -64, 500), (3, 1, -64, 300), (5, -2, -90, 900), (5, 1, 1, 20)]
    w = lm_scoring.learn_weights(rows, 1e-4)
    assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0

    def ll(x):
        p = np.array([[2 ** (-16 / 16), 2 ** (-64 / 16), 1e-4], [0, 2 ** (-64 / 16), 1e-4]])
        return float((np.log(p @ x) * [500, 300]).sum())

    best = ll(w[3])
    for _ in range(200):
        x = np.abs(w[3] + np.random.default_rng(1).normal(0, 0.02, 3)) + 1e-9
        assert ll(x / x.sum()) <= best + 1e-2


def brute_digest(text):
    data = (text or "").encode()
    counts = np.zeros(256, dtype=np.int64)
    for i in range(len(data) - 4):
        for (x, y, z), s in zip(quartile_digest.TRIPLETS, quartile_digest._SALT.tolist()):
            h = int(quartile_digest._TABLE[0][data[i + x]]) ^ int(quartile_digest._TABLE[1][data[i + y]]) ^ int(quartile_digest._TABLE[2][data[i + z]])
            counts[(h * (s | 1) & 0xFFFFFFFF) >> 24] += 1
    return quartile_digest.Digest(counts, len(data))


@pytest.mark.parametrize("chunk", [10_000_000, 20_000])
def test_digests_of_neighbours_equal_brute_force(spark, docs, odd_docs, monkeypatch, chunk):
    monkeypatch.setattr(quartile_digest, "CHUNK_CHARS", chunk)
    own = odd_docs.select("doc_id", "text").filter("doc_id is not null").dropDuplicates(["doc_id"])
    df = docs.filter("doc_id < 60").selectExpr("doc_id + 1000 as doc_id", "substring(text, 1, 1500) as text").union(own)
    rows = sorted(((i, t or "") for i, t in pairs(df)), reverse=True)
    want = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t)
        edited = t[:n - n // 3] + following[:n // 3]
        a, b, c = brute_digest(t), brute_digest(edited), brute_digest(following)
        want[i] = (n, hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), a.likeness(b), a.likeness(c))
    got = quartile_digest.edited_neighbours(df).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    monkeypatch.setattr(quartile_digest, "MOST_PARTS", 2)
    assert sorted(map(tuple, quartile_digest.edited_neighbours(df).collect())) == sorted(map(tuple, got))


def test_digest_edge_rows(spark, odd_docs, no_docs):
    r = quartile_digest.edited_neighbours(odd_docs).collect()
    assert len(r) == odd_docs.count()
    assert all(0 <= x["near_edited"] <= 1 and 0 <= x["near_next"] <= 1 for x in r)
    assert quartile_digest.edited_neighbours(no_docs).count() == 0


def test_chat_query_equals_its_sql(spark):
    import duckdb

    from landfall.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    cur = con.execute(queries.ORACLE["op7_chat_format"])
    names = [c[0] for c in cur.description]
    df = queries.op7_chat_format(spark, SF)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(cur.fetchall())


def test_word_hashes_in_parts(monkeypatch):
    from landfall.llm import common

    text = np.frombuffer(("a bb ccc " * 400 + "x" * 500 + " bb " + "y" * 700).encode(), dtype=np.uint8)
    spans = common.word_spans(text)
    whole = common.word_hashes(text, *spans)
    assert len(set(whole[:1200].tolist())) == 3 and whole[1201] == whole[1]
    for limit in (1, 7, 100, 512):
        monkeypatch.setattr(common, "_HASH_BYTES", limit)
        assert (common.word_hashes(text, *spans) == whole).all()
