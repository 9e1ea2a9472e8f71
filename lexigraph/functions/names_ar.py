"""Language pack of the parts of names in folded Arabic text."""

# Titles that are no part of a name, nisbas too common to tell, second words of honorifics, first words of compounds.
TITLES = set("""
الشيخ الامام القاضي الفقيه الحافظ السيد العالم الزاهد الواعظ الاديب الامير الحاكم الخطيب المحدث الاجل الثقه العلامه المولي الاستاذ الصدر الكبير العارف بالله مولانا المفتي الحنفي الفاضل
المقرئ المقري الكامل الشهير الورع المعروف قاضي القضاه شيخ الاسلام النحوي اللغوي الاصولي المفسر المتكلم الصوفي المسند الرحاله الجليل الاكبر الاعظم النبي الصحابي التابعي المنعوت الملقب
الملك السلطان مولي المدعو الشهيد الوزير الرئيس
""".split())
WEAK_NISBAS = set("الحنفي الفقيه القاضي الامام الشيخ الحافظ".split())
HONORIFIC = set("الدين الايمه الائمه المله الشريعه الاسلام الدوله الحق السنه".split())
COMPOUND = ("عبد", "ابو", "ابي", "ام", "ابن", "ذو", "ذي")
FATHER, GENITIVE_FATHER, SERVANT, SMALL_SERVANT, SON, DAUGHTER = "ابو", "ابي", "عبد", "عبيد", ("بن", "ابن"), "بنت"
OF_GOD = ("الله", "الرحمن")
REPEATS = r"-\s*(?:ثلاثا|مرتين|ثلاث مرات)\s*-"
ARTICLE, NISBA_END = "ال", "ي"
