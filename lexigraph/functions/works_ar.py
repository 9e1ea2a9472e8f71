"""Language pack of works in Arabic and Turkish titles."""

# Marks, quotes, clauses, and the cues that a quoted title is the subject's own, or is not.
MARKS = "[ً-ْٰـ]"
QUOTED, CLAUSE, SENTENCE, ON = r"«([^«»]{2,90})»", r"[.؛:]\s|\n", r"[.؛\n]", "على"
CUE = (
    r"(صنّ?ف|ألّ?ف|التصانيف|تصانيفه|تصانيف|مصنفاته|المصنفات|مصنفات|تآليفه|التآليف|مؤلفاته|له كتاب|وله|له|وسمّ?اه|سمّ?اه|شرحه|شرح|اختصره|اختصر|انتخب|انتقى|نظم|جمع|علّ?ق|حشّ?ى|"
    r"كتب على|رتّ?ب|خرّ?ج أحاديث|وضع|عمل)\s*(?:كتابا|كتاب)?\s*$"
)
AUTHORSHIP = r"(صنّ?ف|التصانيف|تصانيف|مصنفات|تآليف|مؤلفات)"
LISTED = r"(?:المصنفات|مصنفات|التصانيف|تصانيف|الكتب|مؤلفات|المؤلفات|تآليف)\s*[:؛]\s*(?:كتابا|كتاب)?\s*$"
NEGATIVE = (
    r"(قال|ذكره|ذكر|نقل|رأيت|رأيته|حكى|روى|كذا|قرأ|قرأت|سمع|سمعت|درّ?س|أقرأ|حفظ|عرض|صاحب|مصنّ?ف|مؤلف|تفقه|أخذ|نظر|طالع|أفتى|انظر|ترجمته|ليس له|نحوا من|مثل|فى كتاب|في كتاب|المذكورة|يعرف|اشتهر)"
)
BAD_TITLE = r"(قال|رحمه|رضى|رضي|اللهم|سنة|سنه|توفى|توفي|مات|حدثنا|أخبرنا|بن\s)"
# Heads that name the kind of the next title, words that are no title, verbs that tell a kind.
GENERIC = {"شرحا": "شرح", "شرح": "شرح", "حاشية": "حاشية على", "حاشيه": "حاشية على", "حواشي": "حاشية على", "حواشى": "حاشية على", "مختصرا": "مختصر", "مختصر": "مختصر", "تعليقة": "تعليقة على", "تعليقه": "تعليقة على"}
NO_TITLE = set("كتابا كتاب تاريخ رساله رسالة الفتاوى تصانيف مصنف مجلد منه فيه تفسير ديوان مشيخه مشيخة التاريخ".split()) | {"معجم شيوخه"}
VERBS = {"شرح": "sharh", "شرحه": "sharh", "اختصر": "ikhtisar", "اختصره": "ikhtisar", "نظم": "nazm", "حشى": "hashiya", "علق": "hashiya", "خرج أحاديث": "tahric"}
# Beginnings of derived titles and their kinds, for folded Arabic titles and for Turkish ones with a small first letter.
_JOIN = r"(?:[’'](?:l|s|ş|t|d|r|z|n)-|\s+)"
DERIVED = [
    (r"^(?:شرح|شرحه على)\s+", "sharh"), (r"^(?:حاشيه|حواشي|حاشيته|الحاشيه|الحواشي)\s+(?:علي\s+)?", "hashiya"), (r"^(?:تعليقه|تعليق|تعليقات|التعليقه)\s+(?:علي\s+)?", "hashiya"),
    (r"^(?:مختصر|اختصار|منتخب|تلخيص|تهذيب)\s+", "ikhtisar"), (r"^(?:نظم|منظومه في|ارجوزه في)\s+", "nazm"), (r"^(?:تكمله|تتمه|ذيل)\s+", "tekmile"), (r"^تخريج\s+(?:احاديث\s+)?", "tahric"),
    (r"^(?:şerh(?:u|-i|ü)?)" + _JOIN, "sharh"), (r"^(?:hâşiye(?:tü|tu)?|havâşî|ta[‘']?lîk(?:at|a)?)(?:\s+(?:alâ|ale))?" + _JOIN, "hashiya"), (r"^(?:muhtasar(?:u|ü)|ihtisâr(?:u|ü)|telhîs(?:u|ü)|müntehab)" + _JOIN, "ikhtisar"),
    (r"^(?:nazm(?:u|ü)?)" + _JOIN, "nazm"), (r"^(?:tekmile(?:tü|tu)?|tetimme(?:tü)?|zeyl)" + _JOIN, "tekmile"), (r"^(?:tahrîc(?:u|ü)?)(?:\s+ehâdîsi?)?" + _JOIN, "tahric"),
    (r"في شرح\s+(.+)$", "sharh"), (r"\bfî şerh[iu]" + _JOIN + "(.+)$", "sharh"), (r"في تخريج احاديث\s+(.+)$", "tahric"), (r"\bfî tahrîci ehâdîsi\s+(.+)$", "tahric"),
]
