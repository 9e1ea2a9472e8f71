"""Language pack of the transliteration of Arabic names into Turkish scholarly spelling."""

# Letters that assimilate the article and how it is then spelt.
SUN, SUN_TR = "تثدذرزسشصضطظلن", "tsdzrzsşsztzln"
# Titles that a name leaves out.
TITLES = set("""
الإمام الامام العلامة الشيخ الفقيه القاضي الحافظ المحدث المفتي الأمير الامير المقرئ المقري النحوي الأصولي الاصولي الزاهد الواعظ الأديب الاديب المتكلم الصوفي العالم
الكبير الصغير الأكبر الأصغر الحنفي الشافعي المالكي الحنبلي المفسر الخطيب المدرس الرئيس الفاضل الشهيد الأجل الاجل المعمر المسند الثقة العارف الولي السيد الشريف الأوحد البارع
المحقق المدقق الصالح الورع العابد المؤرخ المتفنن المولى الفرضي اللغوي الطبيب الكاتب الوزير السلطان الملك
""".split())
# Words before a byname, those of them that also open an honorific, words that end or carry no name.
KNOWN_AS = set("المعروف المشهور الشهير عرف يعرف ويعرف وعرف الملقب يلقب لقبه المنعوت المدعو المكنى".split())
STYLED = set("الملقب يلقب لقبه المنعوت المدعو المكنى".split())
STOP = set("هو وقيل قيل ويقال يقال صاحب أحد احد من في والد ولد أخو اخو رحمه الله تعالى نسبة إلى الى المتوفى سنة وهو".split())
HONORIFIC = set("الدين الأئمة الائمة الإسلام الاسلام الشريعة القضاة الملة الحق".split())
BYNAME = set("زاده باشا بك بيك خان جلبي أفندي".split())
OF_A_FATHER = set("قاضي شيخ أخي أخت عم بنت".split())
# Father, servant, son, and the word for God.
FATHER, SERVANT, SON, GOD = ("أبو", "ابو", "أبي", "ابي", "أبا"), ("عبد", "عبيد"), ("بن", "ابن"), "الله"
#: What is off before a name is cut into words, what is put apart, and what cuts.
CLEAN = [("[ً-ْٰـ]|\\([^)]*\\)|\\[[^\\]]*\\]", " "), ("(?U)\\bعبد(?=ال)", "عبد "), ("(?U)(?<!\\S)(أبو|ابو)(?=\\S)", "$1 ")]
CUT = r"[\s،,.:؛;\-–—]+"
NO_WORD = "^(?:[0-9٠-٩]+|و)$"

# What a display name is taken from: a byname behind "known as", first words of honorifics, titles that are no nisba.
SHOWN_AS = r"(?:المعروف|الشهير|المشهور|عرف)\s*(?:بـ|ب)\s*(ابن \S+|[^\s،,(.]+(?:\s(?:زاده|باشا|بك|جلبي|أفندي|حلبي|خان|القضاة|الأئمة|الإسلام|الشهيد))?)"
HONOURS = (r"الملقب\s*(\S+ (?:الدين|الأئمة))", r"(\S+ الدين)", r"(\S+ الأئمة)")
HONOUR_HEADS = (
    "شمس فخر برهان ظهير حسام ركن نجم صدر تاج علاء جلال حافظ حميد نور سراج قوام زين بدر شرف كمال أكمل عز عماد نصير رضي مجد سيف جمال محيي قطب صفي شهاب تقي سعد نظام مجير عون بهاء معين ضياء رشيد أمين عفيف ولي حسن خير"
).split()
SHOWN_KUNYA = r"(?:أبو|ابو) (?:عبد )?[^\s،,.]+"
NO_NISBA = "الحنفي القاضي الصوفي الشافعي الحنبلي المالكي الأصولي النحوي".split()
JOINS = "بن ابن عبد أبو أبي ابو".split()
