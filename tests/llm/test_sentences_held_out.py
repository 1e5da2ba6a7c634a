"""Sentences that are in no training text, put together at random, language by language.

Run as a script, it prints what the README says of each language.
"""

import random

from strandline.llm import sentence_lexicon as lex, sentences as ss

HELD_OUT = {
    "en": (
        "The council met at 9.30 a.m. on Tuesday.", "Lt. Gov. Harris and Capt. Ames signed it.", "Profits rose 4.2 percent, i.e. less than planned.", "Why would anyone leave?", "Nobody knew!",
        "She moved to St. Louis in Jan. 1998.", "The firm, Dale & Sons Ltd., was sold.", "He paid $3.50 for it.", "“We are done. Go home,” said the coach.", "Version 2.0.1 fixes that.", "Mr. P. Q. Ward lives at no. 7.",
        "They grow apples, pears, etc., and sell them.", "It happened (as fig. 2 shows) twice.", "40 people came.", "They shut at 8 p.m.", "See pp. 4-9 for more.", "Is it true that Mrs. Gray left?", "She wrote it in the U.S. in 1950.",
    ),
    "de": (
        "Die Sitzung begann um 9.30 Uhr.", "Frau Dr. Klein und Hr. Prof. Vogt kamen zu spät.", "Das gilt z. B. für Kinder, d. h. für alle unter 14.", "Warum ist das so?", "Niemand wusste es!", "Er wohnt in der Nr. 12, vgl. Abs. 3.",
        "Am 24. Dezember war es still.", "Die Firma Beck GmbH wurde verkauft.", "Äpfel, Birnen usw. wachsen dort.", "„Wir sind fertig“, sagte sie.", "Es waren ca. 40 Leute da.", "Sie kam am 3. Mai zurück.", "Das kostet 3,50 Euro bzw. mehr.",
    ),
    "fr": (
        "La séance a commencé à 9 h 30.", "Mme Leroy et M. Petit sont arrivés.", "Cela vaut, p. ex., pour les enfants.", "Pourquoi donc ?", "Personne ne le savait !", "Voir chap. 3, p. 12.", "« Nous avons fini », dit-elle.",
        "Le prix est de 3,50 euros.", "Il y avait env. 40 personnes.", "Le Dr. Morel habite au n° 7.", "Des pommes, des poires, etc. y poussent.",
    ),
    "es": (
        "La sesión empezó a las 9:30.", "El Sr. Gómez y la Dra. Ruiz llegaron tarde.", "Vale, p. ej., para los niños.", "¿Por qué es así?", "¡Nadie lo sabía!", "Véase la pág. 12 del cap. 3.", "«Hemos terminado», dijo ella.", "Cuesta 3,50 euros.",
        "Había aprox. 40 personas.", "Vive en EE. UU. desde 1998.",
    ),
    "ru": (
        "Заседание началось в 9.30.", "Это относится, напр., к детям.", "Почему так?", "Никто не знал!", "См. стр. 12 и рис. 3.", "Он живёт на ул. Мира.", "Яблоки, груши и т. д. растут там.", "Это было 3 мая 1998 г. вечером.",
        "Цена 3,50 руб. за штуку.", "Проф. Иванов и А. Б. Петров пришли.", "«Мы закончили», — сказала она.",
    ),
    "el": ("Η συνεδρίαση άρχισε στις 9:30.", "Ισχύει π.χ. για τα παιδιά.", "Γιατί είναι έτσι;", "Κανείς δεν το ήξερε!", "Βλ. σελ. 12 και κεφ. 3.", "Ο κ. Παπάς ήρθε αργά.", "«Τελειώσαμε», είπε εκείνη.", "Κοστίζει 3,50 ευρώ."),
    "ar": ("بدأت الجلسة في الساعة 9:30.", "لماذا هذا هكذا؟", "لم يعرف أحد!", "وصل د. حسن متأخرًا.", "السعر 3.50 دينار.", "قالت: «انتهينا»."),
    "ur": ("اجلاس 9:30 بجے شروع ہوا۔", "ایسا کیوں ہے؟", "کسی کو معلوم نہ تھا!", "ڈاکٹر احمد دیر سے آئے۔", "قیمت 3.50 روپے ہے۔"),
    "hi": ("बैठक 9:30 बजे शुरू हुई।", "ऐसा क्यों है?", "किसी को पता नहीं था!", "डॉ. शर्मा देर से आए।", "कीमत 3.50 रुपये है।"),
    "ko": ("회의는 9시 30분에 시작되었다.", "왜 그런가요?", "아무도 몰랐어요!", "가격은 3.50달러이다.", "그녀는 \"끝났다. 가자.\"라고 말했다."),
    "ja": ("会議は九時半に始まった。", "なぜそうなのか？", "誰も知らなかった！", "彼女は「終わった。帰ろう。」と言った。", "価格は3.50ドルだ。", "（表2を参照。）", "値は正しい。"),
    "zh": ("会议九点半开始。", "为什么会这样？", "没有人知道！", "她说：“我们做完了。回家吧。”", "价格是3.50元。", "（见表2。）"),
    "th": ("การประชุมเริ่มตอนเช้า", "ทำไมจึงเป็นเช่นนั้น", "ไม่มีใครรู้เลย", "ราคา 3.50 บาทต่อชิ้น", "แอปเปิลขายที่ตลาด"),
    "lo": ("ກອງປະຊຸມເລີ່ມຕອນເຊົ້າ", "ບໍ່ມີໃຜຮູ້", "ລາຄາ 3.50 ກີບຕໍ່ອັນ", "ເປັນຫຍັງຈຶ່ງເປັນແນວນັ້ນ"),
    "it": ("La seduta iniziò alle 9.30.", "Il prof. Bianchi e l'avv. Riva arrivarono tardi.", "Perché è così?", "Nessuno lo sapeva!", "Vedi pag. 12 e cap. 3.", "Costa 3,50 euro."),
    "km": ("កិច្ចប្រជុំចាប់ផ្តើមនៅព្រឹក។", "ហេតុអ្វី?", "គ្មាននរណាដឹងទេ។"),
    "my": ("အစည်းအဝေး စတင်ခဲ့သည်။", "ဘယ်သူမှ မသိဘူး။", "ဘာကြောင့်လဲ။"),
}


def measure(seed=5, paragraphs=400):
    """(recall, precision, sentences) per language, over starts of sentences after a paragraph's first."""
    out, m = {}, ss.model()
    for lang, pool in HELD_OUT.items():
        r = random.Random(seed)
        texts, want = [], set()
        for i in range(paragraphs):
            text = ""
            for j in range(r.randrange(2, 7)):
                if text:
                    text += "" if lang in ("ja", "zh") else r.choice(["\n", " ", " ", " "])
                    want.add((i, len(text)))
                text += r.choice(pool)
            texts.append(text)
        of, a, _ = ss.spans(texts, m)
        got = {(o, x) for o, x in zip(of.tolist(), a.tolist(), strict=True) if x}
        out[lang] = (len(got & want) / len(want), len(got & want) / len(got), len(want))
    return out


def test_no_sentence_is_in_the_training_text():
    known = {s.rstrip(".") for group in (lex.SENTENCES, lex.UNMARKED) for pool in group.values() for s in pool}
    assert not [s for pool in HELD_OUT.values() for s in pool if s.rstrip(".") in known]


def test_held_out_sentences():
    found = measure()
    total = sum(n for _, _, n in found.values())
    assert sum(r * n for r, _, n in found.values()) / total > 0.99, found
    assert sum(p * n for _, p, n in found.values()) / total > 0.99, found


if __name__ == "__main__":
    for lang, (recall, precision, n) in measure().items():
        print(lang, f"{recall:.4f} {precision:.4f}", n)
