import random
import re

import numpy as np
import pytest

from beadloom.llm import language as L

DOC = "doc_id long, text string, lang string"
SAY = {
    "en": "the sample was stored under another name because nobody had written down which tube it came from",
    "de": "die probe wurde unter einem anderen namen gelagert weil niemand aufgeschrieben hatte aus welchem röhrchen sie kam",
    "fr": "cet échantillon a été rangé sous un autre nom parce que personne ne savait dans quel tube il était",
    "es": "la muestra se guardó con otro nombre porque nadie había apuntado de qué tubo venía ni cuándo llegó",
    "it": "il campione è stato conservato con un altro nome perché nessuno aveva scritto da quale provetta veniva",
    "pt": "a amostra foi guardada com outro nome porque ninguém tinha anotado de que tubo ela vinha nem quando chegou",
    "nl": "het monster is onder een andere naam bewaard omdat niemand had opgeschreven uit welke buis het kwam",
    "ru": "проба хранилась под другим именем потому что никто не записал из какой пробирки она была взята",
    "zh": "样品用另一个名字保存因为没有人记下它来自哪一根管子也没有人知道什么时候送到",
}


def line(rng, code):
    w = list(SAY[code]) if code == "zh" else SAY[code].split()
    at = rng.randrange(len(w) - 5)
    return ("" if code == "zh" else " ").join(w[at : at + rng.randrange(5, 12)] + rng.sample(w, 4)) + f" {rng.randrange(999)}"


def made(n, seed, wrong=0.1):
    rng, rows, truth = random.Random(seed), [], {}
    for d in range(n):
        code = rng.choice(L.CODES)
        codes = [code] * rng.randrange(2, 6)
        if rng.random() < 0.2:
            codes.append(rng.choice(L.CODES))
        label = rng.choice(L.CODES) if rng.random() < wrong else rng.choice([code, code.upper(), f" {code}_x", f"{code}-XA"])
        rows.append((d, "\n\n".join(line(rng, c) for c in codes), None if rng.random() < 0.1 else label))
        truth |= {(d, k): c for k, c in enumerate(codes, 1)}
    return rows, truth


def test_held_out_lines(spark):
    rows, truth = made(700, 1)
    got = {(r["doc_id"], r["line_no"]): r["line_lang"] for r in L.line_languages(spark.createDataFrame(rows, DOC)).collect()}
    assert set(got) == set(truth)
    assert np.mean([got[k] == c for k, c in truth.items()]) > 0.98


def test_lines_that_contradict_the_label(spark):
    rows, truth = made(500, 2)
    names = {d: (lang.strip().lower().split("_")[0].split("-")[0] if lang else None) for d, _, lang in rows}
    want = {(d, k, c) for (d, k), c in truth.items() if names[d] != c}
    got = {tuple(r) for r in L.mislabelled_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert len(got & want) / len(got | want) > 0.95


@pytest.mark.parametrize("lang, want", [("en", "en"), (" DE ", "de"), ("fr-CA", "fr"), ("pt_x", "pt"), ("eng", None), ("", None), ("??", None), (None, None), ("\tzh\n", "zh"), ("-en", None)])
def test_labels(spark, lang, want):
    assert spark.createDataFrame([(lang,)], "l string").select(L.named(__import__("pyspark").sql.functions.col("l")).alias("n")).first()["n"] == want


@pytest.mark.parametrize("text, want", [("ACGTNACGTTGA 12.5 3", ""), ("P00002 skin_00009988", ""), ("17 | 3 | 5,044", ""), ("前49行 P00001", "前 行"), ("Der Puck P00017!", "der puck")])
def test_what_speaks_no_language(text, want):
    assert L.plain(text) == want


def by_pattern(line):
    """The rules as one pattern, word by word."""
    noise = r"(?<![A-Za-z])[ACGTN]{6,}(?![A-Za-z])|[A-Za-z]+(?=-[0-9])|[A-Za-z_]*[0-9][A-Za-z0-9_]*|[^\w\s]|[_\d]"
    return re.sub(r"\s+", " ", re.sub(noise, " ", line)).strip().lower()


def test_lines_by_classes_equal_lines_by_a_pattern():
    rng = random.Random(6)
    texts = ["".join(rng.choice("ACGTNACGTNab19_-- é.样\t!²Ж\u00a0٣\U00020000İ\n\n") for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    got = L.lines_of(texts)
    want = [(t, n, by_pattern(x)) for t, text in enumerate(texts) for n, x in enumerate((x for x in text.split("\n") if x.strip()), 1)]
    fold = lambda x: x.replace("i̇", "İ").replace("İ", "?")  # noqa: E731 (its lower case has two characters)
    assert [(t, n, fold(p)) for t, n, p in zip(got.text, got.number, got.strings())] == [(t, n, fold(p)) for t, n, p in want]
    assert got.sizes().tolist() == [len(p) for p in got.strings()]


def test_a_long_line_is_scored_as_a_whole():
    w = np.random.default_rng(1).normal(size=(9, L.PLACES)).astype(np.float32)
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(L.BATCH_CHARS + 1000)).strip()
    lines = L.lines_of(["short one\n" + long, "another"])
    p, _, n = L.presence([lines.strings()[1]])
    assert np.allclose(L.Kernel(w).scores(lines.codes, lines.line, 3)[1], w[:, p].sum(1) / np.sqrt(n[0]), rtol=1e-3, atol=1e-2)


def test_nulls_blank_lines_long_texts_and_clashing_columns(spark):
    rows, _ = made(200, 3)
    long = (SAY["de"] + " ") * 3000
    extra = [(1000, None, "en"), (1001, "", "en"), (1002, " \n\r\n\t", "en"), (1003, "ACGTACGT 1\n\n" + SAY["fr"] + "\r\n" + long, "de"), (1003, SAY["fr"], "de")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows + extra], DOC + ", line_no int, line_lang string")
    got = [(r["doc_id"], r["line_no"], r["line_lang"]) for r in L.line_languages(df).filter("doc_id >= 1000").collect()]
    assert sorted(got, key=str) == sorted([(1003, 1, None), (1003, 1, "fr"), (1003, 2, "fr"), (1003, 3, "de")], key=str)


def test_without_labels_or_documents(spark):
    assert L.line_languages(spark.createDataFrame([], DOC)).count() == 0
    got = L.line_languages(spark.createDataFrame([(1, "some text here\nmore", None)], DOC)).collect()
    assert [(r["line_no"], r["line_lang"], r["confidence"]) for r in got] == [(1, None, None), (2, None, None)]


def test_segments_and_documents(spark):
    lines = spark.createDataFrame([(1, k, c, 0.9, 10) for k, c in enumerate(["en", "en", None, "en", "de", "de"], 1)], "doc_id long, line_no int, line_lang string, confidence double, n_letters long")
    assert sorted((r["first_line"], r["last_line"], r["line_lang"]) for r in L.segments(lines).collect()) == [(1, 4, "en"), (5, 6, "de")]
    r = L.document_languages(lines).first()
    assert (r["doc_lang"], round(r["share"], 3), r["n_languages"]) == ("en", 0.6, 2)


def test_kernel_is_presence_over_the_root_of_both_sizes():
    k, used, z = L.against(["abab", "cd"], ["abab", "ab ab", "xyz"])
    assert np.allclose(k[0, 0], 1) and k[2, 0] < 0.3 and k[0, 1] < 0.3
    p, at, n = L.presence(["aaaa", ""])
    assert n[0] == len(set(p[at == 0])) == 2 + 3 + 3 + 3  # a and blank; aa, " a", "a "; and so on
    w = np.random.default_rng(0).normal(size=(9, L.PLACES)).astype(np.float32)
    lines = [f"line {chr(97 + i % 26) * (i + 1)} of many" for i in range(50)]
    scores = lambda x: (lambda s: L.Kernel(w).scores(s.codes, s.line, len(x)))(L.lines_of(x))
    assert np.allclose(scores(lines)[7:9], scores(lines[7:9]), atol=1e-4)
