"""Term lists and how texts match them.

A lexicon is data: category, terms. Matching compares keys (text.semantic_key), category by category in the lists'
order. Terms are literals of the expression: for lists of this size a chain of contains() inside whole-stage code beats
a theta join. `match_table` is the join for lexicons that come as tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import key_of, let, semantic_key

# The term lists of the domain, one category a line.
SYSTEM_TERMS = {
    "語音與電話系統": ["電話", "語音", "分機", "pbx", "sip", "voip", "總機"],
    "資訊網路系統": ["資訊網路", "網路", "lan", "wan", "wifi", "wi-fi", "交換器", "路由器", "伺服器", "資安", "防火牆", "光纖", "fttb", "onu", "mdf", "idf"],
    "監視系統": ["監視", "cctv", "攝影機", "錄影", "nvr", "影像辨識"],
    "門禁系統": ["門禁", "讀卡", "感應卡", "電鎖", "權限管理", "出入口管制"],
    "停車管理系統": ["停車", "車道", "車輛管制", "進出管理", "出入口管理", "車位", "停管", "柵欄", "車牌", "etag", "e-tag"],
    "中央監控系統": ["中央監控", "bms", "bas", "ba系統", "圖控", "監控點", "io點", "i/o"],
    "能源管理系統": ["能源管理", "ems", "需量", "電表", "水表", "能耗", "分項用電"],
    "廣播與對講系統": ["廣播", "對講", "緊急求救", "求救鈴", "緊急電話", "intercom"],
    "電視與影音系統": ["電視", "數位電視", "共同天線", "catv", "電視插座", "影音", "投影機", "顯示器", "電子布告欄"],
    "通訊涵蓋系統": ["行動通信", "行動通訊", "行動電話", "公眾通信", "電信業者", "訊號涵蓋", "訊號改善", "室內涵蓋", "4g", "5g", "射頻", "強波", "洩波", "漏波"],
    "物聯網與資料平台": ["iot", "物聯網", "資料平台", "api", "資料庫", "資料交換", "通訊協定"],
    "弱電基礎設施": ["弱電", "弱電機房", "電信室", "資訊插座", "機櫃", "機架", "配線架", "纜線", "電纜", "同軸", "配管", "配線", "佈線"],
}
CAPABILITY_TERMS = {
    "signal": ["訊號", "信號", "頻率", "涵蓋", "收訊", "接收", "發射", "射頻", "4g", "5g", "洩波", "漏波"],
    "data": ["資料", "數據", "紀錄", "記錄", "回傳", "上傳", "下載", "儲存", "查詢"],
    "communication": ["通訊", "通信", "傳輸", "網路", "連線", "協定", "頻寬"],
    "monitoring": ["監測", "監視", "狀態", "圖控", "趨勢", "事件"],
    "control": ["控制", "連動", "啟停", "切換", "開啟", "關閉", "觸發", "授權", "權限", "柵欄", "閘門", "電鎖"],
    "sensing": ["感測", "偵測", "偵知", "量測", "讀取", "採集"],
    "identification": ["辨識", "識別", "驗證", "認證", "判讀", "讀卡", "刷卡", "車牌"],
    "display": ["顯示", "看板", "螢幕", "指示", "播送"],
    "alarm": ["告警", "警報", "通知", "求救", "異常"],
    "integration": ["整合", "介接", "連動", "交換", "同步", "匯入", "匯出"],
    "interface": ["介面", "接點", "乾接點", "i/o", "io點", "api", "閘道"],
    "weak_current_infrastructure": ["線路", "線纜", "纜線", "電纜", "光纖", "同軸", "配線", "配管", "插座", "機櫃", "機架", "端點", "節點"],
}
SPACE_TERMS = {
    "地下層": ["地下", "地下室", "地下層", "地下一層", "地下二層", "b1", "b2", "b3", "b4"],
    "停車空間": ["停車", "停車場", "停車空間", "停車區", "車道", "汽車位", "機車位", "卸貨車位"],
    "住宅單元": ["住宅單元", "住戶", "各戶", "居住單元", "客廳", "臥室", "戶內"],
    "公共空間": ["公共空間", "公共區域", "公設", "社區大廳", "門廳", "中庭", "公共廁所"],
    "管理與中控空間": ["管理室", "物管辦公室", "物管櫃台", "中央監控室", "中控室", "警衛室"],
    "機房與設備空間": ["弱電機房", "電信室", "資訊機房", "機房", "設備室", "管道間"],
    "商業與服務空間": ["商業空間", "店舖", "店鋪", "公共服務空間", "社福空間"],
    "屋頂與戶外": ["屋頂", "屋突", "露台", "戶外", "公共開放空間"],
}
SEMANTIC_TERMS = ["資料", "訊號", "通訊", "傳輸", "監測", "監視", "控制", "感測", "辨識", "顯示", "告警", "警報", "連動", "介接", "整合", "協定", "遠端", "紀錄", "記錄", "平台", "回傳", "通知", "狀態", "權限", "授權", "識別", "偵測", "偵知", "涵蓋"]
OBLIGATION_TERMS = ["應", "須", "必須", "不得", "需", "宜", "設置", "提供", "預留", "建置", "配置", "安裝"]
INTERFACE_TERMS = ["消防", "火警", "電梯", "空調", "照明", "給排水", "泵浦", "通風", "排風"]
HEADING_TERMS = ["弱電", "資訊", "通訊", "監控", "智慧建築", "系統整合", "設備規格"]
PLAIN_HEADING_TERMS = ["需求", "規格", "說明", "系統", "設備", "工程", "建築", "停車", "安全"]
NEGATION_TERMS = ["不需", "無須", "不得", "不納入", "不包含", "排除", "免設"]
CONDITION_TERMS = ["但", "惟", "除外", "除非", "若", "如有", "視", "依業主", "待確認"]
GENERIC_TERMS = ["停車", "車道", "車位", "網路", "資料庫", "資料平台", "平台", "設備", "系統", "資料", "紀錄", "記錄", "控制", "整合", "介接", "監測", "監視", "顯示", "通知", "上傳", "下載", "儲存", "查詢", "回傳", "狀態", "權限", "授權", "交換", "同步", "匯入", "匯出", "連線", "傳輸", "事件", "異常", "開啟", "關閉", "啟停", "切換"]
#: Obligation terms that are words only in some surroundings.
GUARDED_OBLIGATIONS = {"需": "需(?!求)", "應": "(?<!對)應(?!用)"}


@dataclass(frozen=True)
class Lexicon:
    systems: dict[str, list[str]] = field(default_factory=lambda: {k: list(v) for k, v in SYSTEM_TERMS.items()})
    capabilities: dict[str, list[str]] = field(default_factory=lambda: {k: list(v) for k, v in CAPABILITY_TERMS.items()})
    spaces: dict[str, list[str]] = field(default_factory=lambda: {k: list(v) for k, v in SPACE_TERMS.items()})
    semantic: list[str] = field(default_factory=lambda: list(SEMANTIC_TERMS))
    obligations: list[str] = field(default_factory=lambda: list(OBLIGATION_TERMS))
    guarded: dict[str, str] = field(default_factory=lambda: dict(GUARDED_OBLIGATIONS))
    interfaces: list[str] = field(default_factory=lambda: list(INTERFACE_TERMS))
    headings: list[str] = field(default_factory=lambda: list(HEADING_TERMS))
    plain_headings: list[str] = field(default_factory=lambda: list(PLAIN_HEADING_TERMS))
    negations: list[str] = field(default_factory=lambda: list(NEGATION_TERMS))
    conditions: list[str] = field(default_factory=lambda: list(CONDITION_TERMS))
    generic: list[str] = field(default_factory=lambda: list(GENERIC_TERMS))
    #: A candidate's topic where no system is named.
    no_system: str = "弱電業務能力候選"


#: The domain's lexicon.
DOMAIN = Lexicon()

#: A lexicon for Latin-script corpora: what documents of a training corpus speak of.
LATIN = Lexicon(
    systems={"licensing": ["license", "licensed", "gnu", "apache", "mit"], "credentials": ["token", "password", "secret"], "contact": ["@mail", "example.com", "555"], "toxicity": ["worthless", "stupid", "hate"]},
    capabilities={"signal": ["tion", "ción"], "data": ["token", "work"], "identification": ["the", "der", "que"], "interface": ["www", "http"], "display": ["est", "ist"]},
    spaces={"english": ["the", "and"], "german": ["und", "der"], "french": ["les", "que"], "spanish": ["los", "para"]},
    semantic=["license", "token", "version", "public", "mail"],
    obligations=["under", "must", "not", "need", "is"],
    guarded={"need": "need(?!le)", "is": r"\bis\b"},
    interfaces=["mit", "cc"],
    headings=["license", "version"],
    plain_headings=["work", "the"],
    negations=["not", "nicht", "pas"],
    conditions=["if", "but", "mais", "pero"],
    generic=["the", "and", "work"],
    no_system="general",
)


def any_term(key: Column, terms: list[str]) -> Column:
    """Whether key contains the key of any term."""
    if not terms:
        return F.lit(False)

    def chain(k: Column) -> Column:
        out = F.contains(k, F.lit(key_of(terms[0])))
        for t in terms[1:]:
            out = out | F.contains(k, F.lit(key_of(t)))
        return out

    return let(key, chain)


def matched(key: Column, terms: list[str]) -> Column:
    """The terms whose key is in key, in order."""
    return F.array_compact(F.array(*[F.when(F.contains(key, F.lit(key_of(t))), F.lit(t)) for t in terms]))


def categories(key: Column, table: dict[str, list[str]]) -> Column:
    """The categories of which key contains a term, in order."""
    return F.array_compact(F.array(*[F.when(any_term(key, terms), F.lit(name)) for name, terms in table.items()]))


def obligations(text: Column, key: Column, lex: Lexicon = DOMAIN) -> Column:
    """Obligation terms in text, in order; guarded ones are looked for in the text, the rest in its key."""
    hits = [text.rlike(lex.guarded[t]) if t in lex.guarded else F.contains(key, F.lit(key_of(t))) for t in lex.obligations]
    return F.array_compact(F.array(*[F.when(h, F.lit(t)) for h, t in zip(hits, lex.obligations, strict=True)]))


def has_obligation(text: Column, key: Column, lex: Lexicon = DOMAIN) -> Column:
    out = any_term(key, [t for t in lex.obligations if t not in lex.guarded])
    for pattern in lex.guarded.values():
        out = out | text.rlike(pattern)
    return out


def system_terms(key: Column, lex: Lexicon = DOMAIN) -> Column:
    """All matched terms of the systems, system by system."""
    return matched(key, [t for terms in lex.systems.values() for t in terms])


def match_table(rows: DataFrame, key: str, lexicon: DataFrame, id_cols: list[str]) -> DataFrame:
    """Hints from a lexicon table (category, category_ord, term_key): for each row of rows the ordered categories.

    A contains() join; Spark broadcasts the lexicon while it is under the broadcast threshold.
    """
    hits = rows.join(lexicon, F.contains(F.col(key), F.col("term_key"))).groupBy(*id_cols).agg(F.array_sort(F.collect_set(F.struct("category_ord", "category"))).alias("hits"))
    return rows.join(hits.select(*id_cols, F.transform("hits", lambda x: x["category"]).alias("categories")), id_cols, "left").withColumn("categories", F.coalesce("categories", F.array().cast("array<string>")))


def lexicon_rows(spark, table: dict[str, list[str]]) -> DataFrame:
    rows = [(c, i, t, key_of(t), j) for i, (c, terms) in enumerate(table.items()) for j, t in enumerate(terms)]
    return spark.createDataFrame(rows, "category string, category_ord int, term string, term_key string, term_ord int")


__all__ = ["DOMAIN", "LATIN", "Lexicon", "any_term", "categories", "has_obligation", "lexicon_rows", "match_table", "matched", "obligations", "semantic_key", "system_terms"]
