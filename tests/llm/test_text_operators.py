"""Text operators against brute force."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import best_fit_packing as bp
from tokenloom.llm import fertility, language_id, ngram_join, quality, viterbi
from tokenloom.llm.fm_index import FMIndex
from tokenloom.llm.substring_dedup import remove_repeats, removal_digest, shard_repeats
from tokenloom.llm.wordhash import utf8, words

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall(text or "")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def removed(texts, size=35):
    every = [tokens(t) for t in texts]
    seen = collections.Counter(tuple(w[j : j + size]) for w in every for j in range(len(w) - size + 1))
    marks = []
    for w in every:
        gone = [False] * len(w)
        for j in range(len(w) - size + 1):
            if seen[tuple(w[j : j + size])] > 1:
                gone[j : j + size] = [True] * size
        marks.append(gone)
    return every, marks


@pytest.mark.parametrize("shard_words", [1 << 19, 40])
def test_removal_digest(docs, shard_words):
    rows = rows_of(docs)
    every, marks = removed([t for _, t in rows])
    want = sorted(
        ((i, len(w), sum(m), hashlib.sha256(" ".join(x for x, gone in zip(w, m) if not gone).encode()).hexdigest()) for (i, _), w, m in zip(rows, every, marks)), key=repr
    )
    got = removal_digest(docs, shard_words=shard_words).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert any(w[2] for w in want)


def test_one_phrase_in_many_texts(spark):
    """A minimiser with more words than a shard: its pieces meet in pairs of blocks, in every order."""
    rng = np.random.default_rng(8)
    phrase = [f"common{x}" for x in range(20)]
    texts = [[f"a{k}x{x}" for x in range(int(rng.integers(10, 30)))] + phrase + [f"b{k}x{x}" for x in range(int(rng.integers(10, 30)))] for k in range(150)]
    for k in range(0, 150, 6):  # windows that also stand in another text, and one that stands twice in its own
        texts.append(texts[k][2:] + [f"tail{k}"])
    texts.append([*texts[1], "mid", *texts[1]])
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    every, marks = removed([t for _, t in rows])
    want = [(i, len(w), sum(m)) for (i, _), w, m in zip(rows, every, marks)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shard_words in (700, 2500):
        got = removal_digest(df, shard_words=shard_words).select("doc_id", "n_words", "n_removed").collect()
        assert sorted(tuple(r) for r in got) == want
    assert sum(w[2] for w in want) > 2000


def test_remove_repeats_keeps_other_columns(docs):
    out = remove_repeats(docs)
    assert out.schema == docs.schema or out.columns == docs.columns
    rows = rows_of(docs)
    every, marks = removed([t for _, t in rows])
    want = sorted((str(i), " ".join(x for x, gone in zip(w, m) if not gone)) for (i, _), w, m in zip(rows, every, marks))
    assert sorted((str(i), " ".join(tokens(t))) for i, t in rows_of(out)) == want
    assert out.where("text is null").count() == 1 and out.where("anchor = 'y'").count() == len(rows)


def test_backward_search_counts():
    rng = np.random.default_rng(3)
    seq = np.append(rng.integers(1, 6, 500), 0).astype(np.int32)
    index = FMIndex(seq, 6)
    for _ in range(50):
        a = int(rng.integers(0, 480))
        pattern = seq[a : a + int(rng.integers(1, 12))]
        lo, hi = np.zeros(1, np.int32), np.full(1, index.n, np.int32)
        for c in pattern[::-1]:
            lo, hi = index.extend(np.array([c], np.int32), lo, hi)
        assert hi[0] - lo[0] == sum((seq[j : j + len(pattern)] == pattern).all() for j in range(len(seq) - len(pattern) + 1))


@pytest.mark.parametrize("seed", range(12))
def test_shard_repeats(seed):
    rng = np.random.default_rng(seed)
    kinds = [[f"w{x}" for x in rng.integers(0, rng.integers(2, 9), rng.integers(1, 9))] for _ in range(3)]
    texts = {tuple((kinds[rng.integers(3)] * 90)[: rng.integers(30, 98)]) for _ in range(6)}
    texts = [list(t) for t in texts]
    for t in texts[::2]:
        t[int(rng.integers(len(t)))] = "zz"
    seen = collections.Counter(tuple(t[j : j + 35]) for t in texts for j in range(len(t) - 34))
    got = collections.defaultdict(set)
    p, lo, hi = shard_repeats(pa.array([" ".join(t).encode() for t in texts]), np.zeros(len(texts), bool), 35, 60 if seed % 2 else 10**6)
    for k, x, y in zip(p.tolist(), lo.tolist(), hi.tolist()):
        got[k] |= set(range(x, y - 34))
    assert [got[k] for k in range(len(texts))] == [{j for j in range(len(t) - 34) if seen[tuple(t[j : j + 35])] > 1} for t in texts]


def shingles(text):
    w = tokens(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, len(s), least.get(top(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def test_join_small(docs):
    got = ngram_join.ngram_jaccard_join(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == components(rows_of(docs))


def test_join_near_copies(spark):
    """Chains, short sets around the light boundary, and a group whose copies mostly miss each other."""
    rng = np.random.default_rng(5)
    base = [f"b{x}" for x in range(80)]
    texts = [" ".join(base)]
    for k in range(120):
        t = list(base)
        for at in rng.integers(0, 80, int(rng.integers(1, 6))):
            t[int(at)] = f"e{k}x{at}"
        texts.append(" ".join(t))
    for n in range(1, 20):
        short = [f"s{n}x{j % 9}" for j in range(n + 4)]
        texts += [" ".join(short), " ".join(short[:-1]), " ".join([*short, "z"]), " ".join(short).upper()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_join.ngram_jaccard_join(df).collect()
    assert sorted((tuple(r) for r in got), key=repr) == components(list(enumerate(texts)))


def _sharing(n, seed):
    """Texts made mostly of a few phrases, so that frequent shingles are in their prefixes; some are near copies."""
    rng = np.random.default_rng(seed)
    phrases = [[f"p{j}x{x}" for x in range(15)] for j in range(7)]
    texts = []
    for k in range(n):
        if k % 10 == 9:
            t = texts[int(rng.integers(len(texts)))].split()
            t[int(rng.integers(len(t)))] = f"c{k}"
        else:
            t = [w for j in rng.permutation(7)[: int(rng.integers(2, 4))] for w in phrases[j]]
            at = int(rng.integers(len(t)))
            t[at:at] = [f"u{k}x{x}" for x in range(int(rng.integers(1, 9)))]
        texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("short,block", [(64, 256), (2, 12)])
def test_join_of_shared_phrases(spark, monkeypatch, short, block):
    monkeypatch.setattr(ngram_join, "SHORT", short)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = list(enumerate(_sharing(350, short)))
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == components(rows)


def test_block_pairs_move_in_waves(spark, monkeypatch):
    """Small blocks are many pairs, more than move at once; the waves find what one would."""
    rows = list(enumerate(_sharing(350, 3)))
    saved, materialize = [], ngram_join.materialize
    for name, value in (("SHORT", 2), ("BLOCK", 6), ("ROOM", 1), ("FILTER", 1 << 15), ("POST_WAVES", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(ngram_join, "materialize", lambda df, name: saved.append(name) or materialize(df, name))
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == components(rows)
    assert saved.count("lists") == 3 and saved.count("near") > 2


def test_only_wanted_texts_pass(spark):
    """All wanted texts pass the bitmap, and nearly no others: only what passes is moved."""
    keys = spark.range(20_000).select(F.col("id").alias("id_key"), F.xxhash64("id").alias("text_key"), F.lit(1).cast("bigint").alias("n_bytes"), F.col("id").cast("string").alias("text"))
    wanted = keys.where("id_key % 10 = 0")
    passing = keys.withColumn("slot", ngram_join._slot()).mapInArrow(ngram_join._passing(ngram_join.slots_of(wanted)), keys.schema)
    got = {r.id_key for r in passing.collect()}
    assert got >= set(range(0, 20_000, 10)) and len(got) < 2_050
    assert not ngram_join.slots_of(wanted.limit(0)).any()


def test_join_with_one_shingle_in_all_prefixes(spark):
    """2,000 texts share three quarters of their shingles but do not link; a few have a copy that does."""
    shared = [f"s{x}" for x in range(34)]
    texts = [" ".join([*shared, *[f"u{k}x{x}" for x in range(10)]]) for k in range(2000)] + [" ".join([*shared, *[f"u{k}x{x}" for x in range(9)]]) for k in range(0, 2000, 100)]
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k if k < 2000 else 100 * (k - 2000) for k in range(len(texts))}


def test_light_sets_meet_exactly_when_they_link():
    for a, b in itertools.product(range(1, ngram_join.MAX_LIGHT + 1), repeat=2):
        need = ngram_join.overlap(a, b)
        for both in range(min(a, b) + 1):
            assert (both >= need) == (100 * both >= 75 * (a + b - both))
    assert ngram_join.choose_boundary({}, {}) == 0
    assert ngram_join.choose_boundary({3: 10, 4: 10}, {3: 500, 4: 500}) >= 4


def test_language_samples_hold_texts_once(spark):
    """One text that is most of a language takes one place, wherever its hash lies, and nothing else is crowded out."""
    rows = [(k, f"palabra {k % 40} común número{k % 40}", "es") for k in range(400)]
    for lang, text in (("xx", "ombra lunga sul muro"), ("yy", "zeta iota kappa")):
        rows += [(1000 + len(rows) + k, text, lang) for k in range(600)] + [(5000 + len(rows) + k, f"{text} {k}", lang) for k in range(3)]
    rows += [(None, "nameless text", "es"), (None, "nameless text", "es"), (7, "repeated id", "es"), (7, "other text", "es"), (9, None, "es"), (10, "123", "es"), (11, "no language", None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, rank int").repartition(3)
    usable = {(lang, t) for i, t, lang in rows if t and lang and re.search("[a-z]", t) and zlib.crc32(str("" if i is None else i).encode()) % 4 != 2}
    every = [(r.lang, r.text) for r in language_id.training_rows(df, 500, 8000).collect()]
    assert len(every) == len(set(every)) and set(every) == usable
    few = [(r.lang, r.text) for r in language_id.training_rows(df, 3, 8000).collect()]
    assert collections.Counter(lang for lang, _ in few) == {lang: min(3, k) for lang, k in collections.Counter(lang for lang, _ in usable).items()}
    assert len(language_id.training_rows(df, 500, 2).collect()) == 2
    got = {r.doc_id: r.lang_pred for r in language_id.identify_languages(df).collect()}
    assert got[1000 + 400] == "xx" and sorted({*got.values()}) == ["es", "und", "xx", "yy"]


def test_words_are_the_pattern():
    texts = ["", " ", "a", "é b  c\x0bd\x1ce", None, "x" * 5000 + " y"]
    w = words(pa.array(texts))
    got = [[bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first, w.first[1:])]
    assert got == [tokens(t) for t in texts]


def test_base_rules(docs):
    for r, (i, t) in zip(sorted(fertility.fertility_rules(docs).collect(), key=lambda r: (str(r.doc_id), r.word_chars)), sorted(rows_of(docs), key=lambda r: (str(r[0]), sum(map(len, tokens(r[1])))))):
        w, text = tokens(t), t or ""
        lines = [x for x in text.split("\n") if WORD.search(x)]
        seen = collections.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        hit = {x for j in range(len(w) - 4) if seen[tuple(w[j : j + 5])] > 1 for x in range(j, j + 5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(w) < 10 or 100 * len(hit) > 20 * len(w)) and not (r.base_failed and r.kept)


def test_fertility_bands_by_script(spark):
    """Scripts that the vocabulary spells with bytes are judged by their own documents."""
    words = {
        "telugu": "తెలుగు భాష చాలా అందమైన భాష మరియు దీనిని కోట్ల మంది ప్రజలు ప్రతి రోజూ మాట్లాడుతారు", "ethiopic": "ሰላም ለዓለም ሁሉ ይሁን እኛ ዛሬ ጠዋት ወደ ገበያ ሄደን ፍራፍሬ ገዛን",
        "lao": "ສະບາຍດີ ຂ້ອຍ ຢູ່ ນະຄອນ ຫຼວງ ວຽງຈັນ ແລະ ມັກ ກິນ ເຂົ້າ ໜຽວ ທຸກ ມື້", "thai": "ฉัน ชอบ กิน ข้าว กับ ปลา ทุก วัน ที่ บ้าน ของ แม่ ใน เมือง",
        "latin": "the quick brown fox jumps over one lazy dog near that quiet river bank",
    }
    rows = []
    for name, text in words.items():
        w = text.split()
        for k in range(8):
            rows.append((len(rows), " ".join(w[k % 3 :][:10]) if k < 3 else " ".join([*w[k:], *w[:k]]), name))
    noise = " ".join(f"ab{chr(0xE000 + k)}{chr(0xE100 + k)}{chr(0xE200 + k)}" for k in range(12))
    rows.append((len(rows), noise, "noise"))
    got = {r.doc_id: r for r in fertility.fertility_rules(spark.createDataFrame(rows, "doc_id long, text string, name string")).collect()}
    for i, text, name in rows[:-1]:
        assert got[i].script == name and got[i].kept, (name, text, got[i])
    assert max(r.byte_share for r in got.values() if r.script == "telugu") > 0.25
    assert got[rows[-1][0]].byte_share > 0.25 and not got[rows[-1][0]].kept


def test_row_scripts():
    texts = ["hello you", "ქართული ენა", "ខ្មែរ", "မြန်မာ", "한국어", "Tiếng Việt", "12 😀", "", "𞤀𞤣𞤤𞤢𞤥", "𠀀𠀁", "русский a", "日本語の"]
    data, off = utf8(pa.array(texts))
    names = fertility.scripts()[0][fertility.row_scripts(data, off)].tolist()
    assert names == ["latin", "georgian", "khmer", "myanmar", "hangul", "latin", "none", "none", "adlam", "han", "cyrillic", "han"]


def test_packing(docs):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(bp.vocabulary_path())
    out = sorted(bp.pack_documents(docs, 64).collect(), key=lambda r: (r.sequence_id, r.offset))
    ids = {i: [*coder.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows_of(docs)}
    assert collections.Counter(r.doc_id for r in out if r.piece == 0) == collections.Counter(i for i, _ in rows_of(docs))
    for r in out:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and (r.piece == 0 or r.length == 64)
    for _, group in itertools.groupby(out, key=lambda r: r.sequence_id):
        end = 0
        for r in group:
            assert r.offset == end
            end += r.length
        assert end <= 64


def test_plan_packs_everything_tightly():
    rng = np.random.default_rng(2)
    for limit in (7, 64, 1024):
        counts = {int(x): int(rng.integers(1, 90)) for x in rng.integers(1, limit + 1, 200)}
        plan = bp.plan_bins(dict(counts), limit)
        got = collections.Counter()
        for times, items in plan:
            assert times > 0 and sum(x * k for x, k in items) <= limit
            for x, k in items:
                got[x] += times * k
        assert got == counts
        assert sum(t for t, _ in plan) <= 1.2 * sum(x * k for x, k in counts.items()) / limit + 1 + sum(k for x, k in counts.items() if 2 * x > limit)
    assert bp.plan_bins({6: 1, 2: 1, 3: 1, 1: 1}, 10) == [(1, [(6, 1), (3, 1), (1, 1)]), (1, [(2, 1)])]


def test_sentencepiece_equals_the_library(docs):
    pieces = viterbi.pieces_of(viterbi.vocabulary_path())
    for r in viterbi.encode_texts(docs).collect():
        text = next(t for i, t in rows_of(docs) if i == r.doc_id) or ""
        assert list(r.ids) == pieces.model.encode(text) and r.decoded and r.viterbi_decoded


def test_viterbi_is_the_best_segmentation():
    pieces = viterbi.pieces_of(viterbi.vocabulary_path())
    for word in ("▁the", "▁inter", "▁a~b", "▁zzx", "▁été"):
        found = pieces.find(np.array([[ord(c) for c in word]], np.uint32))
        heads = np.flatnonzero(pieces.viterbi(found)[0]).tolist()

        def score(cut):
            total = 0.0
            for a, b in itertools.pairwise([*cut, len(word)]):
                k = pieces.model.piece_to_id(word[a:b])
                if word[a:b] == pieces.model.id_to_piece(k) and not pieces.model.is_byte(k):
                    total += pieces.model.get_score(k)
                elif b - a == 1:
                    total += pieces.unknown
                else:
                    return -np.inf
            return total

        every = [(0, *c) for n in range(len(word)) for c in itertools.combinations(range(1, len(word)), n)]
        assert score(heads) == max(map(score, every))


def test_language_accuracy(spark, data_dir):
    out = language_id.op4_language_id(spark, data_dir).join(spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count() > 0


def test_language_edges(docs):
    out = {(r.doc_id, r.lang_pred == "und") for r in language_id.identify_languages(docs).collect()}
    assert {(4, True), (5, True), (6, True), (8, False)} <= out
    assert language_id.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred = 'und'").count() == docs.count()


def test_quality_forest_learns():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.fit_forest(x[:3000], y[:3000])
    assert ((forest.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert np.allclose(quality.fit_forest(x[:0], y[:0]).scores(x[:3]), 0.5)


def test_quality_scores(spark, docs, data_dir):
    table = spark.read.parquet(f"{data_dir}/documents.parquet")
    labels = spark.read.parquet(f"{data_dir}/labels.parquet")
    out = quality.quality_scores(docs, table, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_empty_tables(docs):
    none = docs.where("false")
    assert removal_digest(none).count() == remove_repeats(none).count() == ngram_join.ngram_jaccard_join(none).count() == 0
    assert fertility.fertility_rules(none).count() == bp.pack_documents(none).count() == language_id.identify_languages(none).count() == viterbi.encode_texts(none).count() == 0
