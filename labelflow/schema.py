"""Record schema, label dimensions and other fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The 13 columns of a labelled record, in file order.
CANONICAL_COLUMNS = [
    "platform", "country", "app_id", "app_name", "description",
    "genre", "store_url", "idea_desc", "collected_data",
    "category_id", "function_type", "is_boundary_case", "note",
]

RECORD_SCHEMA = T.StructType([
    T.StructField(
        name,
        T.BooleanType() if name == "is_boundary_case" else T.StringType(),
        True,
    )
    for name in CANONICAL_COLUMNS
])

# Columns that pre-labelling adds for the reviewer; a merge removes them.
AUDIT_COLUMNS = [
    "predicted_category_id", "predicted_category_name",
    "predicted_function_type", "predicted_function_name",
    "category_confidence", "function_confidence", "min_confidence",
    "minority_candidate",
]

# Fixed value: the category of records outside the label domain.
SENTINEL = "EXC"

# Category id -> display name (axis 1).
CATEGORY_NAMES = {
    0: "수면", 1: "정신건강", 2: "운동", 3: "식단",
    4: "만성질환", 5: "여성건강", 6: "유전자", 7: "미용",
}

# Function code -> label index, and -> display name (axis 2).
FUNCTION_INDEX = {"A": 0, "B": 1, "C": 2, "D": 3}
FUNCTION_NAMES = {
    "A": "정보제공", "B": "데이터기록관리", "C": "매칭연결", "D": "개입치료",
}

# Keyword groups that mark a record as a rare-class candidate.
MINORITY_KEYWORDS = {
    "유전자": ["유전자", "dna", "유전", "genetic"],
    "미용": ["피부", "시술", "미용", "성형", "뷰티", "skin", "beauty"],
}

# Default search keywords, in search order.
SEARCH_KEYWORDS = [
    "당뇨 관리", "혈압 관리", "만성질환 관리", "암 환자 관리",
    "복약관리", "복약알림", "처방전 관리",
    "정신건강", "우울증 관리", "명상 앱", "스트레스 관리",
    "원격의료", "비대면 진료", "의료 상담",
    "홈트레이닝", "운동 기록", "다이어트 관리",
    "임신 관리", "산모 건강", "육아 건강",
    "수면 관리", "수면 기록",
    "재활 운동", "물리치료",
    "식단 관리", "영양제 관리", "칼로리 계산",
    "혈당 측정", "심박수 측정", "건강검진 기록",
    "유전자 검사", "유전자 분석", "유전체 분석", "DNA 검사", "정밀의료", "마이크로바이옴",
    "응급 대처", "노인 돌봄", "간병",
    "통증 관리", "희귀질환",
    "피부 관리", "미용 시술 정보", "성형 정보", "뷰티 앱", "피부타입 진단",
    "유전자검사 키트", "질병 유전자 검사", "비만 유전자검사", "탈모 유전자검사",
    "영양유전자검사", "약물유전자검사", "암 유전자검사", "유전성질환 검사", "웰니스 유전자검사",
]

# Fixed value: text between the two fields of the model input.
TEXT_SEPARATOR = " [SEP] 수집 데이터: "

# Fixed value: store URL of a record that carries none (id, language, country).
STORE_URL_TEMPLATE = "https://play.google.com/store/apps/details?id=%s&hl=%s&gl=%s"

# The strings pandas reads as missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Fixed values of the published runs.
DEFAULT_TEST_SIZE = 0.2
DEFAULT_SEED = 42
DEFAULT_PATIENCE = 5
DEFAULT_HITS_PER_KEYWORD = 30
DEFAULT_MAX_LEN = 512

# Headings of the evaluation report, and names of its slices.
REPORT_SECTIONS = [
    ("category", "=== 축1(category_id) 클래스별 성능 (EXC 제외) ==="),
    ("function", "=== 축2(function_type) 클래스별 성능 (EXC 포함 전체 val) ==="),
]
REPORT_SLICES = "=== 축2 성능 비교: 실제 카테고리 행 vs EXC 행 ==="
REPORT_SLICE_NAMES = [("real", "실제 카테고리(EXC 아님)"), ("EXC", "EXC 행")]
