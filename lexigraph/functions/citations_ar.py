"""Language pack of citations of five dictionaries in Arabic notes."""

# The works and how their titles are written.
WORKS = [
    ("jawahir", r"الجواهر\s*المضي[ةه]"),
    ("tabaqat_saniyya", r"الطبقات\s*السني[ةه]"),
    ("taj_tarajim", r"تاج\s*التراجم"),
    ("fawaid", r"الفوائد\s*البهي[ةه]"),
    ("kataib", r"كتائب\s*أعلام\s*الأخ[يب]ار"),
]
# Digits, the words before an entry's number and before a page.
DIGITS = "٠١٢٣٤٥٦٧٨٩"
NUMBER = "[٠-٩0-9]+"
ENTRY_WORD = r"(?:برقم|الرقم\s*:?|رقم\s*:?|ترجمة\s*رقم)"
PAGE_WORD = r"^(?:ص\s*:?\s*|صفحة\s*)"
#: What may stand before a number: a closing quote, an author of one or two words behind "of", an edition in brackets, punctuation.
GAP = r"^[\"”»\s]*(?:ل[^\s(،:؛]+(?:\s+[^\s(،:؛0-9٠-٩]+)?)?[\s،,:]*(?:\([^)0-9٠-٩]*\)[\s،,:]*)?\(?\s*"
#: A number above this is no volume.
VOLUMES = 5
