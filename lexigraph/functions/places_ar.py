"""Language pack of place mentions in folded Arabic text."""

# Verbs and nouns that open a mention of a place, by kind.
TRIGGERS = [
    ("birth", "ولد|مولده|مولدي"), ("death", "مات|توفي|توفاه|وفاته|قتل|استشهد|درج|وفاتي"), ("burial", "دفن|قبره|ضريحه|مدفون"),
    ("travel", "رحل|ارتحل|سافر|قدم|دخل|ورد|انتقل|توجه|وصل|حج|عاد|رجع|خرج|هاجر|وفد|اتي|جاء|هرب|فر|جال"), ("residence", "سكن|استوطن|نزل|قطن|اقام|جاور|توطن|نشا|استقر|مقيما|نزيل"),
    ("office", "قضاء|قاضي|قاضيا|ولي|تولي|وظيفه|مدرسا|درس|خطيب|خطابه|مفتي|افتي|مشيخه|امامه"), ("activity", "حدث|سمع|تفقه|قرا|اخذ|روي|املي|اشتغل|تخرج|برع|اجتمع|لقي"), ("origin", "اهل|اصله|قري"),
]
# Prefixes of a word, letters that may follow a trigger, prepositions, pronouns that refer back, and how far they reach.
JOINED, ENDING = "[وف]", ".{0,3}"
PREFIXES = "[وف]?ب|[وف]?ل|[وف]"
PREPOSITION = "^(?:[وف]?(?:ب|ل)|في|الي|من|[وف]|بلاد|ديار|مدينه|بمدينه|بلده|ببلده|قريه|بقريه|ناحيه|اقليم)$"
PRONOUNS = ("بها", "فيها", "اليها", "منها")
TOKEN, STOP = r"[^\s.؛:،,؟!()\[\]«»\"]+|[.؛:؟!\n]", r"^[.؛:؟!\n]$"
WORDS, WINDOW, REACH = 4, 14, 120
