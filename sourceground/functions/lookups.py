"""Values that results depend on, as plain data."""

from __future__ import annotations

# Constants put on every row (defaults; jobs take them as parameters).
SOURCE_ID = "jicheng_tcm"
SOURCE_NAME = "中醫笈成"
CORPUS_VERSION = "book-20180111"
SOURCE_HOMEPAGE = "https://jicheng.tw/tcm/"
SOURCE_LICENSE = "CC0 for editorial work on public-domain text; CC BY 4.0 for site-authored text; verify per page"

# First token of the category -> category level 1.
CATEGORY_LEVEL1 = {
    "內經": "醫經類", "經論": "醫經類", "難經": "難經類", "傷寒": "傷寒金匱類", "金匱": "傷寒金匱類", "溫病": "溫病類",
    "本草": "本草類", "炮製": "本草類", "方書": "醫方類", "醫方": "醫方類", "醫論": "醫論類", "醫案": "醫案類",
    "診法": "診法類", "診治": "診法類", "脈法": "診法類", "針灸": "針灸類", "經穴": "針灸類", "婦科": "臨證各科",
    "兒科": "臨證各科", "外科": "臨證各科", "傷科": "臨證各科", "喉科": "臨證各科", "眼科": "臨證各科", "齒科": "臨證各科",
    "五官科": "臨證各科", "內科": "臨證各科", "養生": "養生類", "綜合": "綜合類", "其他": "其他",
}
CATEGORY_NONE, CATEGORY_OTHER = "未分類", "其他"

# Tasks that a category is a source for, besides T1.
CATEGORY_TASKS = {
    "醫經類": ["T2", "T3", "T7", "T10", "T12"],
    "難經類": ["T2", "T3", "T7", "T10", "T12"],
    "傷寒金匱類": ["T2", "T3", "T6", "T8", "T9", "T10", "T11", "T12"],
    "溫病類": ["T2", "T3", "T7", "T8", "T10", "T12"],
    "本草類": ["T3", "T4", "T6", "T11", "T12"],
    "醫方類": ["T4", "T5", "T6", "T8", "T9", "T11", "T12"],
    "醫論類": ["T2", "T3", "T7", "T10", "T12"],
    "醫案類": ["T2", "T4", "T5", "T8", "T10", "T12"],
    "診法類": ["T3", "T4", "T7", "T10", "T12"],
    "針灸類": ["T3", "T4", "T7", "T10", "T12"],
    "臨證各科": ["T4", "T5", "T6", "T8", "T11", "T12"],
    "養生類": ["T2", "T3", "T10", "T12"],
    "綜合類": ["T2", "T3", "T4", "T10", "T12"],
}
DEFAULT_TASKS = ["T2", "T3", "T10", "T12"]

# Task code -> (name, English name).
TASKS = {
    "T1": ("標點/句讀恢復", "punctuation_restoration"),
    "T2": ("文白翻譯", "classical_translation"),
    "T3": ("術語注釋", "term_annotation"),
    "T4": ("實體識別", "entity_recognition"),
    "T5": ("關係抽取", "relation_extraction"),
    "T6": ("方劑結構解析", "formula_structure_parsing"),
    "T7": ("理論分類", "theory_classification"),
    "T8": ("方證對應", "syndrome_formula_mapping"),
    "T9": ("類方鑑別", "formula_differentiation"),
    "T10": ("證據溯源問答", "evidence_grounded_qa"),
    "T11": ("安全禁忌判斷", "safety_contraindication"),
    "T12": ("幻覺引用檢測", "hallucinated_citation_detection"),
}
DETERMINISTIC = ("T1", "T6")
MCQ_TASKS = ("T7", "T8", "T9", "T11", "T12")

# Quality tiers.
TIERS = ("test", "candidate", "explore", "unscored")
FORMAL_TIER = "test"

# Books of the pilot corpora, in order.
PILOTS = {
    "pilot1_classics": ["黃帝內經素問", "靈樞", "難經"],
    "pilot2_zhongjing": ["傷寒論_宋本", "金匱要略方論", "金匱要略_條文版", "傷寒論類方", "長沙方歌括", "金匱方歌括"],
    "pilot3_materia_formulae": ["太平惠民和劑局方", "醫方集解", "神農本草經", "本草綱目", "本草備要", "雷公炮炙論", "湯頭歌訣"],
}

# Herbs that call for a safety note, and the note.
SAFETY_HERBS = ("犀角", "麝香", "朱砂", "雄黃", "烏頭", "附子", "砒霜", "水銀", "輕粉", "斑蝥", "馬錢子", "硃砂", "鉛", "丹砂", "巴豆", "大戟")
SAFETY_NOTE = "僅作古籍理解測評，不構成用藥建議。"

# Marks that punctuation restoration removes.
PUNCTUATION = "，。、；：？！「」『』（）()《》〈〉·…—－,.;:?!　\"'"

# Metadata keys with a column of their own.
META_KEYS = ("書名", "作者", "作者描述", "朝代", "年份", "分類", "品質", "參本", "版本", "底本")

# Allowed values of enumerated fields.
INFERENCE_LEVELS = ("direct", "implicit", "external_required")
DIFFICULTIES = ("Easy", "Medium", "Hard", "Expert")
REVIEW_STATES = ("unreviewed", "auto_validated", "expert_approved", "rejected")
PUNCTUATION_STATES = ("source_punctuated", "unpunctuated", "unknown")
