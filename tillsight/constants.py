"""Fixed values and default parameters.

Everything in the block marked FIXED VALUES must stay equal to the values of
the retail workbook process this library re-implements (labels, category map,
default thresholds); changing them changes results.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original process exactly)
# ---------------------------------------------------------------------------

# Product-code prefix (leading letter run) -> category, default "Khác".
CATEGORY_MAP: dict[str, str] = {
    # Khăn Giấy
    'KV': 'Khăn Giấy', 'KR': 'Khăn Giấy', 'KDL': 'Khăn Giấy',
    'KH': 'Khăn Giấy', 'KL': 'Khăn Giấy', 'KB': 'Khăn Giấy',
    'KKDN': 'Khăn Giấy', 'KVK': 'Khăn Giấy',
    # Khăn Ướt
    'KU': 'Khăn Ướt',
    # Giấy Vệ Sinh
    'GC': 'Giấy Vệ Sinh', 'HM': 'Giấy Vệ Sinh',
    'HMK': 'Giấy Vệ Sinh', 'HMH': 'Giấy Vệ Sinh',
    # Bàn Chải & Răng Miệng
    'BC': 'Bàn Chải & Răng Miệng', 'BCN': 'Bàn Chải & Răng Miệng',
    'BCTE': 'Bàn Chải & Răng Miệng', 'BCTEM': 'Bàn Chải & Răng Miệng',
    'BCTEN': 'Bàn Chải & Răng Miệng', 'BCA': 'Bàn Chải & Răng Miệng',
    'BCX': 'Bàn Chải & Răng Miệng', 'BCOCEAN': 'Bàn Chải & Răng Miệng',
    'BCHARU': 'Bàn Chải & Răng Miệng', 'BCAKIRA': 'Bàn Chải & Răng Miệng',
    'BCTEPANDA': 'Bàn Chải & Răng Miệng', 'BCTEELEPHAN': 'Bàn Chải & Răng Miệng',
    'BCUNIQUE': 'Bàn Chải & Răng Miệng', 'BCSILISON': 'Bàn Chải & Răng Miệng',
    'BCJEWELL': 'Bàn Chải & Răng Miệng', 'BCTENEKO': 'Bàn Chải & Răng Miệng',
    'KDR': 'Bàn Chải & Răng Miệng', 'HTKDR': 'Bàn Chải & Răng Miệng',
    'DCKAKA': 'Bàn Chải & Răng Miệng', 'DCTD': 'Bàn Chải & Răng Miệng',
    'LLDORCOTITAN': 'Bàn Chải & Răng Miệng',
    # Tăm Bông
    'TBTE': 'Tăm Bông', 'TB': 'Tăm Bông', 'BTT': 'Tăm Bông', 'BT': 'Tăm Bông',
    # Thực Phẩm & Bánh Kẹo
    'KTN': 'Thực Phẩm & Bánh Kẹo', 'HTK': 'Thực Phẩm & Bánh Kẹo',
    'A': 'Thực Phẩm & Bánh Kẹo', 'CC': 'Thực Phẩm & Bánh Kẹo',
    'VMS': 'Thực Phẩm & Bánh Kẹo', 'HTKD': 'Thực Phẩm & Bánh Kẹo',
    'HTKSB': 'Thực Phẩm & Bánh Kẹo', 'SD': 'Thực Phẩm & Bánh Kẹo',
    'KGC': 'Thực Phẩm & Bánh Kẹo', 'KGLC': 'Thực Phẩm & Bánh Kẹo',
    'XX': 'Thực Phẩm & Bánh Kẹo', 'CG': 'Thực Phẩm & Bánh Kẹo',
    # Bánh Snack
    'HTBTE': 'Bánh Snack', 'HTBSN': 'Bánh Snack', 'HTBD': 'Bánh Snack',
    'HTBX': 'Bánh Snack', 'HTBG': 'Bánh Snack', 'HTBXG': 'Bánh Snack',
    'BWW': 'Bánh Snack', 'BSOGI': 'Bánh Snack', 'BBL': 'Bánh Snack',
    # Nước Uống
    'NSSK': 'Nước Uống', 'TBND': 'Nước Uống', 'TBME': 'Nước Uống',
    'NLREDBULL': 'Nước Uống', 'NLSDN': 'Nước Uống',
    # Chăm Sóc Nhà Cửa
    'NG': 'Chăm Sóc Nhà Cửa', 'NGT': 'Chăm Sóc Nhà Cửa',
    'JA': 'Chăm Sóc Nhà Cửa', 'TC': 'Chăm Sóc Nhà Cửa',
    'TNS': 'Chăm Sóc Nhà Cửa', 'TLM': 'Chăm Sóc Nhà Cửa',
    'BG': 'Chăm Sóc Nhà Cửa', 'NRC': 'Chăm Sóc Nhà Cửa',
    'HTF': 'Chăm Sóc Nhà Cửa', 'HTD': 'Chăm Sóc Nhà Cửa',
    'HTCTBC': 'Chăm Sóc Nhà Cửa', 'LK': 'Chăm Sóc Nhà Cửa',
    'SRT': 'Chăm Sóc Nhà Cửa', 'XM': 'Chăm Sóc Nhà Cửa',
    'HTNM': 'Chăm Sóc Nhà Cửa', 'T': 'Chăm Sóc Nhà Cửa',
    # Yến Sào & Sức Khỏe
    'BV': 'Yến Sào & Sức Khỏe', 'CV': 'Yến Sào & Sức Khỏe',
    'SBOMGROW': 'Yến Sào & Sức Khỏe',
    # Mẹ & Bé
    'NV': 'Mẹ & Bé', 'KT': 'Mẹ & Bé',
}
DEFAULT_CATEGORY = 'Khác'

# Risk levels, highest first.
LEVEL_URGENT = 'Khẩn cấp'
LEVEL_HIGH = 'Cao'
LEVEL_MEDIUM = 'Trung bình'
LEVEL_LOW = 'Thấp'

# Sales actions, in rule order.
ACTION_VISIT = 'Gặp mặt trực tiếp'
ACTION_CALL = 'Gọi ngay'
ACTION_OFFER = 'Zalo offer'
ACTION_FOLLOW_UP = 'Theo dõi định kỳ'
VIP_SEGMENT = 'Khách hàng VIP'

# Default parameters.
LOOKBACK_DAYS = 90
URGENT_THRESHOLD = 0.538023093024565
HIGH_THRESHOLD = 0.35
MEDIUM_THRESHOLD = 0.20
ACTIVE_MODEL_NAME = 'random_forest_calibrated'
ACTIVE_MODEL_VERSION = 'rf_calibrated_2026_05_08'
SOURCE_SYSTEM = 'ExcelDataModel'

# Threshold choice: at most 55 flagged customers, recall at least 0.72,
# candidate grid 0.05 .. 0.95 in 181 evenly spaced steps.
MAX_URGENT = 55
MIN_RECALL = 0.72
GRID_START, GRID_STOP, GRID_STEPS = 0.05, 0.95, 181

# Recent / older revenue windows for the trend feature (days).
TREND_RECENT_DAYS = 30
TREND_OLDER_DAYS = 60
RECENCY_CALL_DAYS = 60
RECENCY_OFFER_DAYS = 30

# Model ranking order (all descending).
MODEL_RANK_METRICS = ('roc_auc', 'average_precision', 'f2', 'precision')

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

NUMERIC_FEATURES = (
    'recency', 'frequency', 'aov', 'promo_rate', 'margin', 'trend',
    'days_since_first', 'active_months',
)
FEATURE_COLUMNS = ('segment',) + NUMERIC_FEATURES
