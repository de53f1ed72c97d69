import random
import zlib

import numpy as np

from mediamart.llm import language_id as li


def by_rule(text, s):
    return by_rule_of(text, [s])


def fold(text):
    return [int(li.FOLD[b]) for b in text]


def tree_of(text):
    cells, n = np.unique(li.codes(text), return_counts=True)
    return li.Tree(cells, n.astype(float)).grow()


def test_every_context_sums_to_one():
    rng = np.random.default_rng(1)
    tree = tree_of(rng.integers(97, 105, 3000).astype(np.uint8).tobytes())
    for context in [b"abc", b"hha", b"zzz", b"  a", b"a\xff\xfe"] + [rng.integers(97, 105, 3).astype(np.uint8).tobytes() for _ in range(30)]:
        asked = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], np.uint32)
        assert abs(np.exp2(-tree.bits(asked)).sum() - 1) < 1e-9


def test_code_length_is_that_of_the_context_tree():
    """Sparse levels against the rule, on seen, half-seen and unseen bytes."""
    for text in (b"abracadabra abracadabra", "мама мыла раму, мама".encode(), b"x"):
        tree, s = tree_of(text), [32] * li.ORDER + fold(text)
        for word in (b"abra", b"zzab", b"adab", b" abr", b"qqqq", "мыло ра".encode(), b"A1 9\t\xff"):
            assert np.allclose(tree.bits(li.codes(word)), by_rule(word, s), atol=1e-9)


def test_query_against_brute_force(spark, documents):
    """Learning, prediction and score of whole rows against the rule, language by language."""
    rng = random.Random(2)
    words = {"en": "the cat and dog of a house".split(), "de": "der hund und die katze im haus".split(), "ru": "кот и собака в доме на".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randrange(1, 9))), lang, "s") for i in range(60) for lang in [rng.choice(list(words))]]
    rows += [(70, "кот and hund", None, "s"), (71, "日本 7", None, "s")]
    taught = {lang: [] for lang in words}
    for i, text, lang, _ in rows:
        if lang and zlib.crc32(str(i).encode()) % 4 != 2:
            taught[lang].append([32] * li.ORDER + fold(text.encode()))
    got = {r.doc_id: r for r in li.identify(documents(rows)).collect()}
    for i, text, _, _ in rows:
        want = {lang: sum(by_rule_of(text.encode(), parts)) for lang, parts in taught.items()}
        best = min(sorted(want), key=want.get)
        assert got[i].lang_pred == best and abs(got[i].bits - want[best] / len(text.encode())) < 1e-3
        assert abs(got[i].score - 1 / sum(2 ** (want[best] - x) for x in want.values())) < 1e-2


def by_rule_of(text, parts):
    """``by_rule`` over several learned texts: each starts after blanks of its own."""
    follow = {}
    for s in parts:
        for i in range(li.ORDER, len(s)):
            for k in range(li.ORDER + 1):
                got = follow.setdefault(tuple(s[i - k:i]), {})
                got[s[i]] = got.get(s[i], 0) + 1

    def p(context, x, barred):
        got = {y: n for y, n in follow.get(context, {}).items()}
        if not got:
            return p(context[1:], x, barred) if context else 1 / 256
        total, d = sum(got.values()), len(got)
        if x in got:
            return got[x] / (total + d)
        mass = 1 - sum(p(context[1:], y, None) if context else 1 / 256 for y in got)
        return d / (total + d) * (p(context[1:], x, None) if context else 1 / 256) / mass

    t = [32] * li.ORDER + fold(text)
    return [-np.log2(p(tuple(t[i - li.ORDER:i]), t[i], None)) for i in range(li.ORDER, len(t))]


def test_two_minority_languages_of_one_script(spark, documents):
    """Two languages in Cyrillic, 0.3 % of a corpus in English each, that differ in the
    frequencies of their letters and endings."""
    rng = random.Random(4)
    english = [w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang = 'en'").limit(50).collect()
               for w in r.text.split()][:4000]
    word = lambda letters, weights, ends: "".join(rng.choices(letters, weights, k=rng.randrange(2, 7))) + rng.choice(ends)
    letters = "абвгдежзиклмнопрстуя"
    first, second = [rng.randrange(1, 9) for _ in letters], [rng.randrange(1, 9) for _ in letters]
    text = lambda which: " ".join(word(letters, which[0], which[1]) for _ in range(60))
    rows = [(i, " ".join(rng.choices(english, k=60)), "en", "s") for i in range(9940)]
    rows += [(20000 + i, text((first, ["ый", "ать", "ом"])), "aa", "s") for i in range(30)]
    rows += [(30000 + i, text((second, ["ия", "ут", "ам"])), "bb", "s") for i in range(30)]
    got = {r.doc_id: r for r in li.identify(documents(rows)).where("doc_id >= 20000 OR doc_id % 50 = 0").collect()}
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got.values() if r.held_out]
    assert sum(truth[r.doc_id] != "en" for r in held) >= 8
    assert all(r.lang_pred == truth[r.doc_id] for r in held)


def test_pieces_of_languages_change_nothing(monkeypatch):
    texts = {lang: (w * 30).encode() for lang, w in (("a", "eins zwei "), ("b", "one two "), ("c", "uno dos "), ("d", "un deux "))}
    trees = {lang: tuple(np.unique(li.codes(t), return_counts=True)) for lang, t in texts.items()}
    asked = [b"one two three", "zwei é".encode(), b"\xff" * 200000]
    whole = li._Lookup(li.Model(trees)).totals(asked)
    monkeypatch.setattr(li, "PIECE_CELLS", 1)
    lookup = li._Lookup(li.Model(trees))
    assert lookup.step == 1 and np.allclose(lookup.totals(asked), whole, rtol=1e-5)


def test_noise_and_untaught_languages_go(spark):
    rng = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    noise = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") if rng.random() < 0.85 else " " for _ in range(400)) for _ in range(20)]
    noise += ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(200)) for _ in range(20)]
    noise += ["Szczęście przyjaźń mężczyzna źdźbło chrząszcz brzmi w trzcinie żółwie wszczęły wrzawę pod krzyżem " * 3,
              "мама мыла раму и пела песню о далёкой стране за синим морем " * 3]
    odd = spark.createDataFrame([(10 ** 6 + i, t, None, "s", len(t)) for i, t in enumerate(noise)], docs.schema)
    kept = {r.doc_id for r in li.reject_unknown(docs.unionByName(odd)).select("doc_id").collect()}
    assert not any(x >= 10 ** 6 for x in kept)
    lettered = {r.doc_id for r in docs.collect() if r.text and any(map(str.isalpha, r.text))}
    assert len(lettered - kept) <= 0.005 * len(lettered)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    got = li.identify(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(documents):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", "s") for i in range(40)]
    rows += [(100, None, "en", "s"), (101, "", "de", "s"), (102, "123 ... 456", None, "s"), (None, "the dog", "en", "s"),
             (104, "und die katze " * 9000, None, "s"), (104, "und die katze " * 9000, None, "s")]
    got = {}
    for r in li.identify(documents(rows, extra=True)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [got[i][0].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100][0].score == 0
    assert got[None][0].lang_pred == "en" and not got[None][0].held_out
    assert [r.lang_pred for r in got[104]] == ["de", "de"]
    kept = li.reject_unknown(documents(rows, extra=True))
    assert kept.columns == documents(rows, extra=True).columns and kept.count() == len(rows) - 3
    assert li.identify(documents([]).limit(0)).collect() == []
    unlabelled = li.identify(documents([(1, "text", None, "s")])).collect()
    assert unlabelled[0].lang_pred == "und"
