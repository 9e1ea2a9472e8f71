"""Language pack of relation mentions in folded Arabic text. Another language is another module of these names."""

# The grammar's rules (pattern at the start of a word, role, relation) in the order in which they are tried.
TRIGGERS = (
    (r"تفقه (?:عليه|به)\b", "student", "fiqh"),
    (r"تفقه (?:علي|عند)\b", "teacher", "fiqh"),
    (r"تفقه ب(?=[^\s.،]{3,})", "teacher", "fiqh"),
    (r"(?:اخذ|يروي|روي) (?:الفقه |العلم |العلوم |الادب |الحديث |القراءات |التفسير )?عنه\b", "student", "took"),
    (r"(?:يروي|روي) (?:هذا |ذلك )?(?:الكتاب|كتابه|الحديث|تصانيفه|مصنفاته) عنه\b", "student", "took"),
    (r"(?:احد|من) (?:مشايخ|شيوخ|اشياخ)\b", "student", "took"),
    (r"اخذ (?:الفقه |العلم |العلوم |العلوم الشرعيه |الادب |الحديث |القراءات |التفسير |الطريقه )?عن\b", "teacher", "took"),
    (r"(?:يروي|روي|حدث)(?: بها| ب\S+)? عن\b", "teacher", "hadith"),
    (r"سمع منه\b", "student", "hadith"),
    (r"سمع من\b", "teacher", "hadith"),
    (r"سمع(?= (?:ابا|ابي|ابن|\S+ بن )\S)", "teacher", "hadith"),
    (r"قرا عليه\b", "student", "read"),
    (r"قرا (?:[^ .،]+ ){0,3}علي\b", "teacher", "read"),
    (r"تخرج (?:به|عليه)\b", "student", "fiqh"),
    (r"تخرج (?:علي|ب)\b", "teacher", "fiqh"),
    (r"(?:صحب|لازم|لزم)\b", "teacher", "companion"),
    (r"(?:من اصحاب|تلميذ|من تلامذه|من تلاميذ)\b", "teacher", "companion"),
    (r"(?:هو |وهو |كان )?استاذ\b", "student", "fiqh"),
    (r"وعنه\b", "student", "took"),
)
# What may stand before a trigger, and the words that end a mention.
BEFORE_TRIGGER, JOINED = r"(?<![^\s،.(«:])", "(?:و|ف|ثم )?"
CLAUSE_END = (
    r"[.؛:!؟?\n\[]| (?:و|ف|ثم )?(?:تفقه|سمع|روي|يروي|قرا|اخذ|كان|مات|توفي|ولي|درس|قال|قدم|رحل|حدث|برع|صنف|له|وله|هو|وهو|حتي|سنه|في سنه|ببغداد|ببخاري|بسمرقند|بدمشق|بمصر|بالقاهره|بحلب|"
    r"بمرو|ببلخ|بنيسابور|بمكه|بالمدينه|وجماعه|وغيره|وغيرهما|وغيرهم|وخلق|وطبقته|في اخرين|مثل|منها|الاتي|المتقدم|المذكور|تقدم|ياتي|وسياتي|انتهي|ونحوه|وامثاله|ممن|منهم|الذي|التي|بها|به|"
    r"ذكره|ذكر|رضي|رحمه|قيل|انه|يقال|فقال|فلما|لما|في|فيما|من طبقه)\b"
)
# Beginnings that are no person, titles before a name and formulas behind it.
NOT_PERSON = (
    r"^(مذهب|مذاهب|الحديث|الكثير|جماعه|علماء|فضلاء|مشايخ|شيوخ|اهل|اكابر|افاضل|بعض|غير|كثير|جمع|عده|خلق|الفقه|العلم|علم|كتب|كتاب|الكتب|الطريق|فيه|منه|عنه|لي|له|ذلك|هذا|هذه|ان|انه|"
    r"الحنفيه|الحنابله|الشافعيه|المالكيه|مشايخها|علمايها|فضلايها|اصحابه|اصحابنا|عصره|زمانه|بلده|النبي|رسول|الراي|المذهب)\b"
)
TITLES = (
    r"^(?:(?:امام الهدي|امام الحرمين|الشيخ|الامام|امام|العلامه|القاضي|الفقيه|الحافظ|المولي|المولى|السيد|الاستاذ|الصدر|قاضي القضاه|شيخ الاسلام|شيخ الشيوخ|الشريف|الاديب|الخطيب|المسند|المحدث|"
    r"الزاهد|العارف|الكبير|الاجل|المقري|الرييس|العالم|الفاضل|الكامل|الجليل|المفتي|صاحب) )+"
)
TAIL = (
    r"(?: (?:رحمهم الله|رحمهما الله|رحمه الله|رضي الله عنه|رضي الله عنهم|تعالي|وغيره|وغيرهم|وغيرهما|وجماعه|الكتب|وجماعته|وطبقته|في اخرين|وخلق|وامثالهم|ونحوهم|الاتي ذكره|المتقدم ذكره))+$"
)
# Words for kin and their relation.
KIN = {
    "ابيه": "father", "والده": "father", "اباه": "father", "ابوه": "father", "عمه": "uncle", "جده": "grandfather", "خاله": "maternal_uncle", "اخيه": "brother", "اخوه": "brother",
    "اخاه": "brother", "ابنه": "son", "ولده": "son", "ابناه": "son", "حفيده": "grandson", "ابن اخيه": "nephew", "ابن اخته": "nephew", "صهره": "in_law", "زوجها": "husband", "ابنته": "daughter",
}
# The preposition between the links of a chain, the relations whose chains have two links or three, what ends a trigger that a chain may follow.
OF, CHAIN_OF_TWO, CHAIN_OF_THREE, FROM_HIM, UPON, SON = "عن", ("took", "fiqh"), ("read",), "عنه", "علي", "بن"
# The joined "and", words that only look as if they had it, words after which it belongs to the name.
AND_PREFIX, AND_WORD = "و", None
NO_AND = set("وهب وكيع واصل وضاح ورقاء واقد الوليد وهبان وجيه وحيد ولي ولده والده ولداه ولديه والدي".split())
NAME_START = set("ابي ابو ابا ابن بن عبد ام بنت".split())
COMMA = "،"
# What describes the name before it, and where such a description is no trigger.
DESCRIBES = r"(?:تلميذ|تلامذه|صاحب|شارح|مصنف|مولف|استاذ|والد|شيخ|خال|جد|قاضي بلده|الماضي|الاتي|المتقدم|المذكور)\b"
APPOSITION = r"(?:تلميذ|من تلامذه|من تلاميذ)"
VERBS = r"(?:تفقه|اخذ|قرا|سمع|روي|تخرج|تلميذ|تلامذه|صحب|لازم) "
# How a name looks, and a work that stands for its author.
NAME_LIKE = (r"(^| )(بن|ابن|بنت)( |$)", r"^(ابي|ابو|ابا|ام) ", r"\S+ (?:الدين|الايمه|الاسلام|المله|الشريعه|القضاه|المشايخ|العلماء|الحق)\b")
SHORT_NAME_LIKE = r"(^| )ال\S{2,}ي$"
LIST_WORD = r"^(?!ال)[ء-ي]{3,8}$"
REFERENCE = r"\s*\bXREF(\d+)\b\s*"
LATER = r"^(?:س?ياتي|تقدم|المذكور|الاتي|الماضي)\b"
LEAD = r"^(?:و)?(?:علي|من) (?!بن )|^(?:صاحبه|صاحباه|تلميذه) (?=(?:ابو|ابي|ابا|الامام|القاضي|الشيخ|\S+ بن ))"
# Fixed value: "companion of X" at the very beginning.
OPENING = r"^(?:(?:الفقيه|الامام|القاضي|الشيخ|العلامه|المحدث|الزاهد|المقري)،? ){0,3}صاحب ((?:الامام |الشيخ |القاضي )?(?!ال)[^\s«\"'(]\S*(?: [^\s،.«]+){0,6})"
OPENING_END = r" (?:و?كان|و?تفقه|و?روي|و?سمع|و?اخذ|و?هو|ثقه|يكني|مات|توفي)\b"
