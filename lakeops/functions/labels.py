"""Labels and edges that results are compared by."""

# Recency ladder, upper edge in days, then the rest.
RECENCY_EDGES = [7, 14, 30, 60, 90, 150, 180]
RECENCY_LABELS = [
    "01_7日以内", "02_14日以内", "03_30日以内", "04_60日以内",
    "05_90日以内", "06_150日以内", "07_180日以内", "08_それ以上",
]

# Frequency ladder (low, high, label). A count of 4 has no bucket.
FREQUENCY_RANGES = [
    (1, 1, "01_1回"), (2, 2, "02_2回"), (3, 3, "03_3回"),
    (5, 10, "04_5-10回"), (11, 20, "05_11-20回"), (21, 50, "06_21-50回"),
    (51, None, "07_50回以上"),
]
FREQUENCY_DEFAULT = "00_その他"

# Average order value ladder, upper edge, then the rest.
MONETARY_EDGES = [500, 1000, 2000, 3000, 4000, 5000, 10000]
MONETARY_LABELS = [
    "01_500円未満", "02_500以上-1000円未満", "03_1000以上-2000円未満",
    "04_2000以上-3000円未満", "05_3000以上-4000円未満", "06_4000以上-5000円未満",
    "07_5000以上-10000円未満", "08_10000以上",
]

# Order value ranges of the profile report (low, high, label).
PRICE_RANGES = [
    (0, 1000, "1_0円〜1000円未満"), (1000, 5000, "2_1001円〜5000円未満"),
    (5000, 10000, "3_5001円〜10000円未満"), (10000, 30000, "4_10000円〜30000円未満"),
]
PRICE_DEFAULT = "5_30000円以上"

# Purchase count groups of the profile report.
FREQUENCY_GROUPS = [
    (1, 2, "01_1回〜2回"), (3, 10, "02_3回〜10回"),
    (11, 20, "03_11回〜20回"), (21, 50, "04_21回〜50回"),
]
FREQUENCY_GROUP_DEFAULT = "05_51回以上"

# Spend segments.
SEGMENT_HIGH = "高価格層"
SEGMENT_MID = "中価格層"
SEGMENT_LOW = "低価格層"

# Age groups.
AGE_EDGES = [35, 55]
AGE_LABELS = ["若年層", "中年層", "シニア層"]

# Review topics and feedback classes.
REVIEW_TOPICS = [
    "食事と飲み物", "機内エンターテイメント", "機内Wi-Fiと接続性", "価格に対する価値",
    "地上サービス", "機内スタッフのサービス品質", "座席の快適さ",
]
FEEDBACK_CLASSES = [
    "品揃え・在庫", "品質", "コスパ・お得感", "接客・サービス", "店舗設備・環境", "その他",
]
