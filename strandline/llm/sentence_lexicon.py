"""Fixed values for sentence boundaries: abbreviations, marks, and the sentences the tagger learns from."""

from __future__ import annotations

#: Abbreviations that something always follows in the same sentence.
INNER = (
    "rev hon gen sen rep fig figs nos p pp app cf vs eq vol ch dept approx e.g i.e viz al art ed "
    "capt lt lieut cmdr sgt cpl maj gov pres supt attn tel ext resp incl excl avg max ca c.f sect par para tab illus trans "
    "z h z.b d.h u.a bzw vgl nr ca evtl ggf sog inkl bspw abs bd s o.g i.d.r u.u m.e zzgl exkl mind max tel str kap ziff aufl hrsg dipl ing "
    "dott sig sigg sig.ra ing avv geom rag ecc p.es es cfr pag pagg "
    "drs dhr mevr mw bijv d.w.z o.a blz ong "
    "np tj tzn tzw ul prof inż mgr dr.hab "
    "p.ex ex c.-à-d env réf n° chap "
    "p.ej ej núm pág págs ee ee.uu cap ud uds vid aprox "
    "см стр рис т т.е напр п пп гл ул им проф акад тов г-н г-жа "
    "βλ σελ π.χ δηλ κ κα αρ παρ κεφ εικ πιν τόμ τηλ λεωφ καθ δρ σημ "
    "د أ م डॉ श्री सं डा ڈاکٹر"
).split()
#: The same, but only with a capital letter: "Ms. Reed", not "9 ms. Then".
TITLES = "mr mrs ms dr prof st no hr fr sr sra srta dra mm mme mlle m ver resp col brig adm insp mgr mgrs messrs mt ft frl".split()
#: Abbreviations that can also end a sentence.
EITHER = (
    "a.m p.m am pm inc ltd co corp llc plc gmbh u.s u.k e.u etc jr esq sec min ms hr hrs std uhr u.s.a "
    "usw u.a.m etc uu "
    "т.д т.п д пр др г гг в вв руб тыс млн млрд "
    "κ.λπ κ.ά π.μ μ.μ"
).split()
#: Months, days and the like, which a number may follow in the same sentence.
DATES = (
    "no jan feb mar apr jun jul aug sep sept oct nov dec mon tue tues wed thu thur thurs fri sat sun "
    "janv févr avr juil déc ene abr ago dic okt dez янв фев февр апр авг сент окт нояб дек"
).split()
#: Words that follow a time or number in the same sentence.
JOINED = (
    "utc gmt cet cest est edt pst pdt bst "
    "januar februar märz april mai juni juli august september oktober november dezember quartal jahrhundert halbjahr kapitel"
).split()

#: Sentences of the training text by language; every one is a whole sentence.
SENTENCES: dict[str, tuple[str, ...]] = {
    "en": (
        "The keeper closed gate 4 at noon.", "Mr. Alder and Dr. Finch met Prof. K. Lowe near pier 7.", "See fig. 3 and p. 12 for the plan.",
        "Tickets cost 3.50, i.e. 2 coins each.", "Bring a lamp, e.g. the old one.", "Use e.g. Paris or Rome.", "It left at 5 a.m. from the dock.",
        "The ferry sails at 7 p.m.", "We woke at 6 a.m. UTC and rowed.", "He works for Larch Inc.", "Larch Inc. sells rope.", "She lives in the U.S.",
        "The U.S. harbour was shut.", "Was it 2.5 or 3.0 miles?", "Stop that boat now!", "Did you really say so?!", "We waited ... and nobody came.",
        "The reply was no…", "Ropes, sails, etc. and tar were sold.", "They sold ropes, sails, etc.", "Wait 5 sec. per turn.", "It took 9 min. to row.",
        "It took only 9 min.", "It took 80 ms.", "The copy ended within 7 ms.", "He left it to us.", "The table is ORG.", "Compare red vs. blue, cf. note 4.", "J. R. Stone wrote version v2.1.", "\"Is the tide in?\" asked the cook.",
        "\"Hold the line!\" shouted J. Stone.", "The mate said \"wait for me\" and ran.", "The log read: \"All is well. Nobody slept.\"",
        "He said that “the sea is calm. It always was.” and slept.", "(The same held in 1902; cf. p. 9 of the log.)", "Read No. 12 in app. C, p. 3.",
        "row_count is null here.", "deck_plan must be set first.", "tide_time was wrong.", "e-mails came late, e.g. at noon.", "iPads were sold there.", "pH is 7 in here.",
        "x-ray is late.", "van Gogh painted it.", "eBay bought it.", "de Vries wrote the plan.", "mRNA was found in it.", "cargoList is short.", "pier2 is shut.", "macOS was late.", "_draft was kept.", "log4j is old.", "Owner: the crew, dept. 5.",
        "Capt. Hale and Lt. Moss met Sgt. Pike.", "We met on Feb. 3 at noon.", "It began in Sept. 1902 at sea.", "The fair was in Oct.", "He left on Mon.", "They sailed 9 km.", "It weighs 4 kg.", "The rope is 30 cm.", "Send it to Blvd. Nord.", "Ask for Msgr. Bell.", "See Hdbk. 4 for it.",
"Set it to 9.", "Nobody came (see note 3).",
        "The files are in log.txt.", "We kept 40 rows - again.", "25 boats came back.", "7 sailors slept.", "1902 was a dry year.", "3,400 ropes were sold.", "12 of them sank.", "The sign said: \"No entry. Keep out.\"", "She wrote: “It rains. We stay.”",
        "They moored in the U.K.", "The shop shuts at 6 p.m.", "The answer came after 9 sec.", "It rang for 40 ms.", "It’s late, and they’ll say so.", "Nothing was lost, was it?", "Ask Ms. Reed.",
        "The keys differ by 4, approx. 20 percent.",
    ),
    "de": (
        "Der Wärter schloss das Tor um 12 Uhr.", "Herr Dr. Falk traf Prof. K. Lohe.", "Siehe Nr. 5, z. B. die Liste.", "Die Summe ist 4,5 %, d. h. 20 Boote.", "Es sind ca. 3 Boote, z. B. 2 alte.", "Es sind ca. 9 Boote, d. h. zu viele.",
        "Am 3. Quartal lag es nicht.", "Es war der 8. März um 9 Uhr.", "Wir brauchen 4 Std.", "Nach ca. 5 Min. je Boot war Schluss.", "Es kamen u. a. alte Netze vor.",
        "Der Wert fehlt, bzw. er ist leer.", "Die Summe passt nicht …", "Boote sofort anhalten!", "Warum fehlt das Netz 7?", "Der Weg ist 7 km.", "Herr Dipl. Ing. Kern kam mit Frl. Beck.", "Siehe Bd. 3 und Abs. 2.", "Vgl. Nr. 8 in plan.txt, z. B. Netze.",
        "„Das Boot liegt still. Keiner weiß warum.“, schrieb der Koch.", "Es dauerte 3 Min.", "Netze, Seile usw. lagen dort.", "Das Seil kostet 3,50 Euro, vgl. Nr. 4.",
    ),
    "fr": (
        "Le gardien ferme la porte à 12:30.", "M. Aubin et Mme Lenoir sont partis.", "Voir p. 4, cf. le n° 12.", "Il faut env. 9 barques, c.-à-d. 3 de plus.",
        "Prenez p. ex. la vieille lampe.", "Où est la clé ?", "Arrêtez la barque !", "La corde est perdue…", "« La mer est calme. Personne ne dort. », écrit le mousse.",
        "Le mousse a noté : « La mer est calme. Personne ne dort. »", "Des cordes, des voiles, etc. dans le port.", "Le Dr. Aubin demande : qui dort ?", "L’eau monte de 2,5 %.",
    ),
    "es": (
        "El guarda cerró la puerta a las 12:30.", "El Sr. Vega y la Sra. Luna salieron.", "Véase el núm. 4, pág. 9.", "Tome p. ej. la lámpara vieja.",
        "Los barcos de EE. UU. llegan tarde.", "¿Dónde está la llave?", "¡Pare el barco!", "Todo estaba bien...", "Salió a las 8 p. m. y volvió.", "Tardó aprox. 5 min.",
        "El mozo dijo: «El mar está en calma. Nadie duerme».", "Sube un 2,5 %, es decir, 4 metros.",
    ),
    "ru": (
        "Сторож закрыл ворота в 12 часов.", "См. стр. 4 и рис. 2 в книге.", "Лодок мало, т. е. пять.", "Сети, канаты и т. д. лежали там.", "Весла, якоря и пр. готовы.",
        "Это было 8 марта 1902 г. без ветра.", "Он приехал 9 мая 1901 г.", "Напр. по ключу 7.", "Д-р Орлов ушёл.", "Где лодка?", "Остановите лодку!", "«Море тихо. Никто не спит.» — сказал кок.",
        "Лодка ждёт, см. п. 3.", "Купили сети и т. д.", "Разница 2,5 %, напр. для лодки 4.",
    ),
    "el": (
        "Ο φύλακας έκλεισε την πύλη.", "Βλ. σελ. 4 στο βιβλίο.", "Πάρτε π.χ. τη λάμπα.", "Είναι λίγα, δηλ. 5 σκάφη.", "Πού είναι το κλειδί;", "Σταματήστε το πλοίο!",
        "Η βάρκα 7 έφυγε στις 9:30.", "«Η θάλασσα είναι ήρεμη. Κανείς δεν κοιμάται.», είπε ο μάγειρας.", "Γιατί λείπει το σχοινί;",
    ),
    "ar": ("أغلق الحارس الباب عند الساعة 12.", "قال د. سامر إن القارب وصل.", "أين المفتاح؟", "أوقفوا القارب!", "البحر هادئ؛ ثم هاج.", "الفرق هو 2.5 في المئة."),
    "ur": ("چوکیدار نے دروازہ بند کیا۔", "چابی کہاں ہے؟", "کشتی 7 دیر سے پہنچی۔", "کشتی روک دیں!", "فرق 2.5 فیصد ہے۔"),
    "km": ("អ្នកយាមបានបិទទ្វារ។", "សោនៅឯណា?", "ទូកលេខ 7 មកយឺត។"),
    "my": ("တံခါးစောင့်သည် တံခါးကို ပိတ်ခဲ့သည်။", "သော့ဘယ်မှာလဲ။", "လှေ 7 နောက်ကျသည်။"),
    "hy": ("Պահակը փակեց դուռը։", "Նավը ուշացավ։"),
    "am": ("ጠባቂው በሩን ዘጋው።", "ጀልባው ዘገየ።"),
    "it": ("Il custode chiuse la porta.", "Il dott. Neri e la sig.ra Conti partirono.", "Vedi pag. 4, cfr. il n. 12.", "Dov'è la chiave?"),
    "hi": ("पहरेदार ने दरवाज़ा बंद किया।", "डॉ. मेहता ने नाव रोकी।", "चाबी कहाँ है?", "नाव रोकें!", "अंतर 2.5 प्रतिशत है।"),
    "ko": ("문지기가 문을 닫았다.", "열쇠는 어디에 있습니까?", "배를 멈추세요!", "선원은 \"바다가 고요하다. 아무도 없다.\"라고 적었다.", "배 7은 2.5% 늦었다."),
    "ja": (
        "門番は門を閉めた。", "鍵はどこですか？", "船を止めてください！", "理由は不明……。", "水夫は「海は静かだ。誰もいない。」と書いた。", "「まだ待つのか？」と料理人が尋ねた。",
        "船は（図3を参照。）遅れている。", "版v2.1は新しい。",
    ),
    "zh": (
        "守门人关上了门。", "钥匙在哪里？", "请停船！", "我们等了……但是没有人来。", "水手写道：“海面平静。没有人。”", "“潮水来了吗？”厨师问。", "（详见图3第4页。）", "先开门，再关门；然后走。", "差异为2.5%。",
    ),
}
#: Sentences of a script without sentence marks; their punctuation is stripped before training.
UNMARKED: dict[str, tuple[str, ...]] = {
    "lo": ("ຄົນເຝົ້າປະຕູປິດປະຕູແລ້ວ.", "ເປັນຫຍັງເຮືອຈຶ່ງມາຊ້າ?", "ເຮືອ 7 ອອກຕອນເຊົ້າ.", "ກະແຈຂອງ Alder ຢູ່ໃສ?", "ທະເລສະຫງົບຫຼາຍ."),
    "th": ("คนเฝ้าประตูปิดประตูแล้ว.", "ทำไมเรือจึงมาช้า?", "เรือ 7 ออกตอนเช้า.", "กุญแจของ Alder อยู่ที่ไหน?", "ทะเลสงบมากครับ.", "กรุณาหยุดเรือทันที!", "ส่วนต่างคือ 2.5 เปอร์เซ็นต์ของเรือ."),
}
