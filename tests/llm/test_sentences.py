import itertools
import random

import numpy as np
import pytest

from strandline.llm import sentences as ss


def split(text):
    of, a, b = ss.spans([text], ss.model())
    return [text[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]


@pytest.mark.parametrize(
    "parts",
    [
        ["Dr. Hale saw 3.5 boats, e.g. two red ones.", "It was 5 a.m. then.", "Why?"],
        ["He lives in the U.S.", "The U.S. mail is late.", "net_id is null."],
        ['"Is it late?" asked M. Roe.', 'They wrote: "It is done. Nobody came."', "Good."],
        ["He said that “all is well. It was.” and left.", "(See p. 9 for more.)", "Then he ran … away."],
        ["Das war am 3. März um 9 Uhr.", "Es sind ca. 5 Std.", "Siehe z. B. Nr. 7, d. h. 4 Boote."],
        ["Où est-il ?", "M. Petit a lu le n° 4, c.-à-d. 5 pages.", "Fin."],
        ["Los datos de EE. UU. llegan.", "¿Por qué?", "¡Pare!", "El núm. 4 falta."],
        ["Сети и т. д. тут.", "Это было 8 марта 2020 г. утром.", "«Всё тихо. Никого нет.» — сказал он.", "Конец."],
        ["Πού είναι το κλειδί;", "Βλ. σελ. 4.", "Έφυγε."],
        ["पहला वाक्य।", "डॉ. राव आए।", "क्यों?"],
        ["أين هو؟", "قال د. سامي نعم.", "انتهى."],
        ["کشتی کہاں ہے؟", "وہ آئی۔", "بس۔"],
        ["문이 닫혔다.", "그는 \"끝났다. 가자.\"라고 말했다.", "왜 그렇습니까?"],
    ],
)
def test_spaced_scripts(parts):
    for gap in (" ", "\n", "  ", "\r\n"):
        assert split(gap.join(parts)) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["门关了。", "“谁来了？”他问。", "他写道：“好了。走吧。”", "（见第3页。）", "我们等了……但是没人。"],
        ["門は閉まった。", "「誰だ？」と彼は尋ねた。", "彼は「終わった。行こう。」と書いた。", "船（図3を参照。）は遅い。", "不明……。"],
    ],
)
def test_scripts_without_spaces(parts):
    assert split("".join(parts)) == parts


def test_thai():
    assert split("เรือออกแล้ว ทำไมจึงช้า เรือ 7 ของ Alder มาถึง\nประตูปิด") == ["เรือออกแล้ว", "ทำไมจึงช้า", "เรือ 7 ของ Alder มาถึง", "ประตูปิด"]


def test_structure():
    text = (
        "## Plan of v1.2\n\nThe text goes\non here. And\nhere too.\n\nCheck these:\n1. Ask Mr. T. Roe\n2. Purge it. Then stop.\n- keep 3.5\n\n-----\n"
        "2026-01-02 03:04:05 INFO done. next=1\n[2026-01-02T03:04:05Z] ERROR a. B c\tx\n\nHe kept 4 rows\n- again. Good.\n\n* * *\n ﻿ No end"
    )
    assert split(text) == [
        "## Plan of v1.2", "The text goes\non here.", "And\nhere too.", "Check these:", "1. Ask Mr. T. Roe", "2. Purge it.", "Then stop.", "- keep 3.5",
        "2026-01-02 03:04:05 INFO done. next=1", "[2026-01-02T03:04:05Z] ERROR a. B c\tx", "He kept 4 rows\n- again.", "Good.", "No end",
    ]


@pytest.mark.parametrize("parts", [["1. OK.", "Next step."], ["2) No!", "Retry."], ["a) No!", "Retry."], ["12. OK.", "Next step."], ["123) No!", "Retry."]])
def test_short_first_sentence_of_an_item(parts):
    assert split("Steps:\n" + " ".join(parts)) == ["Steps:", *parts]


def test_short_first_sentence_of_an_item_without_spaces():
    assert split("步骤：\n1. 完了。次へ。") == ["步骤：", "1. 完了。", "次へ。"]


@pytest.mark.parametrize(
    "parts",
    [
        ["Capt. Smith met Lt. Jones.", "They left."], ["It was on Jan. 5, not Sept. 9.", "Why?"], ["Il dott. Rossi è qui.", "Bene."], ["Msgr. Bell spoke.", "He ran 5 km.", "She isn't.", "Then he slept."],
        ["ទ្វារបិទ។", "ហេតុអ្វី?"], ["တံခါး ပိတ်သည်။", "သူလာသည်။"], ["Նավը եկավ։", "Նա գնաց։"], ["ጀልባው መጣ።", "ሄደ።"],
        ["Wait" + "." * 40 + "!" * 30, "Yes" + ")" * 9 + ".", "It is done." + ")" * 7, "The end."],
    ],
)
def test_words_and_marks_of_any_kind_and_length(parts):
    assert split(" ".join(parts)) == parts


def test_lists_with_long_numbers_and_lao():
    assert split("Steps:\n10234. Go there. Stop.\n10235. Sit down.") == ["Steps:", "10234. Go there.", "Stop.", "10235. Sit down."]
    assert split("ເຮືອອອກແລ້ວ ກະແຈຢູ່ໃສ") == ["ເຮືອອອກແລ້ວ", "ກະແຈຢູ່ໃສ"]


@pytest.mark.parametrize("text", ["", " ", "\n\n", "....", "﻿", "!?", "-----\n***", "   \r\n\t"])
def test_nothing(text):
    assert split(text) == []


def test_paragraphs_of_training_sentences():
    # Other paragraphs of the sentences that the model learned from; test_sentences_held_out has new sentences.
    texts, marks = ss._training_texts(12345, 1500)
    of, a, _ = ss.spans(texts, ss.model())
    got = {(int(o), int(x)) for o, x in zip(of, a, strict=True) if x}
    want = {(i, m) for i, ms in enumerate(marks) for m in ms}
    hit = len(got & want)
    assert hit / len(got) > 0.995 and hit / len(want) > 0.995


def test_viterbi_and_expectations_against_enumeration():
    rng = np.random.default_rng(5)
    zone = np.repeat([0, 1, 2], [1, 5, 4])
    score, step = rng.normal(size=10), rng.normal(size=(2, 2))
    tags = ss.viterbi(zone, score, step)
    chance, steps = ss.expectations(zone, score, step)
    total = np.zeros((2, 2))
    for z in range(3):
        s = score[zone == z]
        values, mean = {}, np.zeros(len(s))
        for y in itertools.product((0, 1), repeat=len(s)):
            values[y] = sum(a * t for a, t in zip(s, y, strict=True)) + sum(step[p, t] for p, t in zip((1, *y), y, strict=False))
        norm = sum(np.exp(v) for v in values.values())
        for y, v in values.items():
            p = np.exp(v) / norm
            mean += p * np.array(y)
            for a, b in zip((1, *y), y, strict=False):
                total[a, b] += p
        assert tuple(tags[zone == z]) == max(values, key=values.get)
        assert np.allclose(chance[zone == z], mean)
    assert np.allclose(steps, total)


def test_blocks_make_no_difference(monkeypatch):
    r = random.Random(1)
    base = ss._training_texts(9, 60)[0]
    text = "\n\n".join(r.choice(base) for _ in range(80))
    whole = split(text)
    monkeypatch.setattr(ss, "BLOCK", 400)
    parts = [text[at + i : at + j] for at, p in ss.pieces(text) for _, i, j in zip(*(x.tolist() for x in ss.spans([p], ss.model())), strict=True)]
    assert parts == whole
    each = [x for t in base for x in split(t)]
    of, a, b = ss.spans(base, ss.model())
    assert [base[o][i:j] for o, i, j in zip(of, a, b, strict=True)] == each


def test_documents(spark):
    rows = [(1, "One. Two."), (1, "One. Two."), (2, None), (3, ""), (4, "x" * 200_000 + ". End."), (None, "Null id.")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, start_char int")
    got = sorted((tuple(r) for r in ss.split_documents(df, "doc_id", "text").collect()), key=str)
    assert got == sorted([(1, 0, 4), (1, 5, 9), (1, 0, 4), (1, 5, 9), (4, 0, 200_001), (4, 200_002, 200_006), (None, 0, 8)], key=str)
    assert ss.split_documents(df.limit(0), "doc_id", "text").count() == 0
