"""Measures against direct calls of the vocabularies, and bands against plain quartiles."""

import base64
import math
import random
from collections import Counter

import public_tokenizers
import sentencepiece
import tiktoken

from quarry.llm import fertility

from . import brute


def tokens_of(text):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    level = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    words = brute.WORD.findall(text)
    ids = [i for w in words for i in pieces.encode(w)]
    share = [n / len(ids) for n in Counter(ids).values()]
    n = sum(len(level.encode_ordinary(f" {w}")) for w in words)
    return n, sum(map(len, words)) / n, sum(map(pieces.is_byte, ids)) / len(ids), -sum(p * math.log2(p) for p in share)


def measured(text):
    return fertility.measure(text, fertility.vocabularies(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")))


def test_measures_are_those_of_the_vocabularies(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) BETWEEN 100 AND 900").limit(5).collect()]
    for text in [*texts, "𝕬𝖇𝖈 ༄ naïve 日本語の文章 🙂🙂 x\x0by", "Ünder größe\nλόγος"]:
        r = measured(text)
        assert r["script"] in fertility.SCRIPTS
        for found, expected in zip((r["n_tokens"], r["chars_per_token"], r["byte_share"], r["token_entropy"]), tokens_of(text)):
            assert math.isclose(found, expected, abs_tol=1e-9)


def test_scripts():
    said = {"latin": "Grüße an alle", "cyrillic": "мир и дом, words", "greek": "λόγος", "cjk": "日本語 ok", "other": "კომიტეტი", "devanagari": "शब्द", "kana": "ひらがな漢字", "hangul": "한국어", "arabic": "كلمة", "hebrew": "מילה", "thai": "คำ"}
    assert {s: fertility.main_script(t) for s, t in said.items()} == {s: s for s in said} and set(said) == set(fertility.SCRIPTS) and fertility.main_script("12 34") == "other"


def test_bands_reject_what_lies_outside(spark):
    rng = random.Random(2)
    words = "the house stood on a hill above the river and people came from every village to see old trees in the garden".split()
    docs = [(k, " ".join(rng.choice(words) for _ in range(150))) for k in range(200)]
    odd = {
        1000: " ".join("".join(rng.choice("qxzjkvw#*%") for _ in range(9)) for _ in range(22)),  # many tokens for its letters
        1001: " ".join(w + "༄" if k % 3 == 0 else w for k, w in enumerate(rng.choice(words) for _ in range(70))),  # spelt in bytes
        1002: " ".join(["the"] * 4 + [f"{a}{b}" for a in "abcdefghijklmnop" for b in "abcdefgh"]),  # a flat distribution
        1003: "too short",
        1004: None,
    }
    docs = spark.createDataFrame(docs + list(odd.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in fertility.quality_rules(docs).collect()}
    assert all(found[k].kept and not found[k].failed_bands for k in range(200))
    assert not any(found[k].kept for k in odd) and found[1003].base_failed and found[1004].failed_bands == []
    for m in fertility.MEASURES:
        assert any(m in found[k].failed_bands for k in (1000, 1001, 1002)), m


def test_verdicts_by_plain_quartiles(spark, sf):
    rows = fertility.op4_fertility(spark, "/root/testdata/sf0.01").collect()
    groups, scripts = {}, {}
    for r in rows:
        if not r.base_failed:
            groups.setdefault((r.script, int(math.log2(max(1, r.n_tokens)))), []).append(r)
            scripts.setdefault(r.script, []).append(r)
    for (script, _), own in groups.items():
        failed = {r.doc_id: set() for r in own}
        measure = own if len(own) >= fertility.LEAST_TEXTS else scripts[script]
        assert len(measure) >= fertility.LEAST_TEXTS
        for m, (least, low, high) in fertility.MEASURES.items():
            ranked = sorted(r[m] for r in measure)
            a, b = (ranked[math.ceil(q * len(ranked)) - 1] for q in (0.25, 0.75))
            reach = fertility.FENCE * max(b - a, least)
            for r in own:
                if low and r[m] < a - reach or high and r[m] > b + reach:
                    failed[r.doc_id].add(m)
        assert all(r.kept == (not failed[r.doc_id]) and set(filter(None, r.failed_bands.split(","))) == failed[r.doc_id] for r in own)
    assert any(r.failed_bands for r in rows)


#: A plain sentence of each script, in words.
SAID = {
    "latin": "the committee will publish the report next week once all members have read and signed the final version of it together",
    "cyrillic": "комиссия опубликует доклад на следующей неделе когда все её члены прочтут и подпишут окончательный вариант этого документа",
    "greek": "η επιτροπή θα δημοσιεύσει την έκθεση την επόμενη εβδομάδα όταν όλα τα μέλη θα έχουν διαβάσει και υπογράψει το τελικό κείμενο",
    "cjk": "委员会 将 于 下周 公布 报告 届时 所有 成员 都 已 阅读 并 签署 最终 版本 的 文件",
    "kana": "いいんかい は らいしゅう ほうこくしょ を はっぴょう する よてい です すべて の メンバー が よんで サイン します",
    "hangul": "위원회는 모든 위원이 최종 문서를 읽고 서명한 뒤 다음 주에 보고서를 발표할 예정이라고 오늘 오후 기자들에게 밝혔다",
    "arabic": "ستنشر اللجنة التقرير في الأسبوع المقبل بعد أن يقرأ جميع الأعضاء النسخة النهائية ويوقعوا عليها في مقر الهيئة",
    "hebrew": "הוועדה תפרסם את הדוח בשבוע הבא לאחר שכל החברים יקראו ויחתמו על הנוסח הסופי של המסמך במשרדה",
    "devanagari": "समिति अगले सप्ताह रिपोर्ट प्रकाशित करेगी जब सभी सदस्य अंतिम संस्करण को पढ़ कर उस पर हस्ताक्षर कर देंगे",
    "thai": "คณะกรรมการ จะ เผยแพร่ รายงาน ใน สัปดาห์ หน้า เมื่อ สมาชิก ทุก คน ได้ อ่าน และ ลง นาม ใน ฉบับ สุดท้าย แล้ว",
}


def test_every_script_rejects_junk(spark):
    """By its own band where it has texts, and by constants where it has few; a text alone in its size is measured too."""
    rng = random.Random(5)
    many, few, junk = [], [], {}
    for k, (script, said) in enumerate(SAID.items()):
        words, letters = said.split(), sorted({c for c in said if c.isalpha()})
        said_of = lambda n: " ".join(rng.choice(words) for _ in range(n))
        many += [(1000 * k + i, said_of(60)) for i in range(40)]
        few += [(1000 * k + i, said_of(60)) for i in range(3)]
        rare = max(letters, key=said.count) if k else "q"
        junk[1000 * k + 900] = " ".join(rng.choice([rare, letters[0]]) for _ in range(60))  # two letters: no entropy
        junk[1000 * k + 901] = " ".join("".join(chr(rng.randrange(0x10A0, 0x10F0)) if rng.random() < 0.3 else rng.choice(letters) for _ in range(5)) for _ in range(60))
    junk[901 + 10**6] = " ".join("".join(rng.choice("qxzjkvwbcdfghm") for _ in range(9)) for _ in range(2000))  # alone in its size
    for plain in (many, few):
        docs = spark.createDataFrame(plain + list(junk.items()), "doc_id long, text string")
        found = {r.doc_id: r for r in fertility.quality_rules(docs).collect()}
        assert {found[1000 * k].script for k in range(len(SAID))} == set(SAID)
        assert all(found[i].kept for i, _ in plain), [(found[i].script, found[i].failed_bands) for i, _ in plain if not found[i].kept]
        base = [i for i in junk if found[i].base_failed]
        assert not any(found[i].kept for i in junk), [(found[i].script, found[i].asDict()) for i in junk if found[i].kept]
        assert len(base) <= len(SAID)
