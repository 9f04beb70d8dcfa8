from __future__ import annotations

import pytest

from colloquy.llm import mojibake as m

CLEAN = [
    "The host sold a small recipe behind the café every Monday.", "“Both friends” kept a naïve story – it’s true.", "दो दोस्त, एक चाय और बहुत सारी बातें हुईं।", "शाम को सर्दियों में छोटा भाई कहानी लिखता है।", "Вчера певица рассказала длинную песню на рынке.",
    "Утром портной продал забавную новость во дворе, и учительница записала историю.", "L’été dernier l’élève a préféré une très longue mémoire.", "இரவில் என் பாட்டி வயலில் புத்தகத்தை விளக்கினார்கள்.", "کل پڑوسی میٹھی کتاب بانٹتے ہیں۔", "Amanhã a mãe escreveu uma difícil canção.",
]
DOC = "doc_id long, text string, line string, dirty boolean, key long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "", True, 1) for i, t in enumerate(texts)], DOC)


def seen_as(text, wrong, errors="strict"):
    if wrong == "cp1252":
        back = {b: c for c, b in m.TABLES["cp1252"].items() if not (0x80 <= ord(c) < 0xA0 and bytes([b]).decode("cp1252", "ignore"))}
        return "".join(chr(b) if b < 0x80 else back[b] for b in text.encode())
    return text.encode().decode(wrong, errors)


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850"])
def test_restored_exactly(spark, wrong):
    texts = CLEAN * 3
    bad = [seen_as(t, wrong) for t in CLEAN]
    got = {r.doc_id: r.original for r in m.restored(frame(spark, texts + bad)).collect()}
    assert set(got) == set(range(len(texts), len(texts) + len(bad)))
    assert all(got[len(texts) + i] == t for i, t in enumerate(CLEAN))


def test_other_ways(spark):
    twice = seen_as(seen_as(CLEAN[3], "cp1252"), "cp1252")
    swapped = CLEAN[2].encode("utf-16-le").decode("utf-16-be")
    legacy = CLEAN[5].encode("cp1251").decode("koi8_r")
    chinese = CLEAN[0].replace("é", "’t").encode().decode("gb18030", "replace")
    part = CLEAN[2] + "\n" + seen_as(CLEAN[3], "mac_roman")
    lost = CLEAN[0].encode("latin-1").decode("utf-8", "replace")
    rows = CLEAN * 4 + [twice, swapped, legacy, chinese, part, lost, twice]
    got = {r.doc_id: r.original for r in m.restored(frame(spark, rows)).collect()}
    n = len(CLEAN) * 4
    assert set(got) == set(range(n, n + 7))
    assert got[n] == got[n + 6] == CLEAN[3] and got[n + 1] == CLEAN[2] and got[n + 2] == CLEAN[5] and got[n + 3] == CLEAN[0].replace("é", "’t") and got[n + 4] == CLEAN[2] + "\n" + CLEAN[3]


def test_nothing_to_find(spark):
    odd = [None, "", " ", "plain", "СССР» и «Р»", "—état", "ˈʃʱː ṅī", "é", "👍🏽", "λόγος, φωνή", "x" * 200_000]
    assert m.restored(frame(spark, CLEAN + odd)).count() == 0
    assert m.restored(frame(spark, [])).count() == 0


def test_learned_mappings(spark):
    rows = CLEAN + [seen_as(t, "cp1252") for t in CLEAN] + [seen_as(CLEAN[0], "mac_roman")]
    got = {(r.name, r.seen, r.original) for r in m.learn(frame(spark, rows)).collect()}
    assert ("cp1252", "Ã©", "é") in got and ("mac_roman", "√©", "é") in got and ("cp1252", "à¤š", "च") in got


def test_mappings_of_unlisted_encodings_are_learned_and_applied(spark):
    assert "cp775" not in m.TABLES
    shown = ["Le café de l’été, où la mère préférée chante à la fête.", "La mère a déjà préféré l’été à la fête, où est le café ?"]
    apart = "Une préférence très chère à l’élève"  # no twin of its own
    rows = CLEAN * 3 + shown * 2 + [seen_as(t, "cp775") for t in [*shown, apart]]
    docs = frame(spark, rows)
    assert ("twin", seen_as("é", "cp775"), "é") in {(r.name, r.seen, r.original) for r in m.learn(docs).collect()}
    got = {r.doc_id: r.original for r in m.restored(docs).collect()}
    n = len(CLEAN) * 3 + 4
    assert got == {n + i: t for i, t in enumerate([*shown, apart])}


def test_chance_twins_teach_nothing(spark):
    line = "पड़ोसी {} किताब सीखना चाहते हैं।"
    rows = [*CLEAN, line.format("मीठी"), line.format("मीठी") + " ", seen_as(line.format("धीमी"), "cp1252"), seen_as(line.format("धीमी"), "cp1252") + " "]
    assert m._features(rows[-2])[0] == m._features(rows[-4])[1]
    assert m.learn(frame(spark, rows)).where("name = 'twin'").count() == 0
    assert m.restored(frame(spark, rows)).where("doc_id >= 12").first().original == line.format("धीमी")


def test_learned_mappings_decide():
    judge = m.Judge({"é": 50, "è": 50}, {"cp1252"}, {}, {"cp1252": {"Ã©": "è"}})
    assert judge.turn_back("Ã©") == ("è", "cp1252") and judge.turn_back("Ã¨") == ("è", "cp1252")
    assert m.Judge({"é": 50}, {m.TWIN}, {}, {m.TWIN: {"ħŋ": "é"}}).restore("cafħŋ ħŋx") == (True, "café éx", ["twin"])


def test_lost_characters_are_filled_in(spark):
    rows = [*CLEAN, CLEAN[0], "दुकान में चाय", "My café.", "A cliché, a clichy.", CLEAN[0].replace("é", "�") + " café", "da�s na�ve caf� x�", None, ""]
    docs = frame(spark, rows)
    turned = m.restored(docs)
    got = {r.doc_id: r.original for r in m.repair_lost(docs, turned).collect()}
    n = len(CLEAN)
    assert set(got) == {n + 4, n + 5}
    assert got[n + 4] == CLEAN[0] + " café" and got[n + 5] == "da�s naïve café x�"
    assert m.repair_lost(docs.limit(0), turned.limit(0)).count() == 0


def test_words_that_fit():
    assert set(m._patterns("añb")) == {"�ñb", "�b", "a�b", "a�", "añ�", "�ñ�"}
    assert m._words("caf� x9, नमस्ते। ok") == {"caf�", "नमस्ते"}
