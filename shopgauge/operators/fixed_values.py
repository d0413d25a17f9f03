"""Fixed values of the plants: names, codes and constants that results must carry exactly."""

# Inspection kind, chart names, warning names.
PATROL = "巡检"
CHART_INDIVIDUAL = "单值和移动极差图"
CHART_MEAN_RANGE = "均值极差图"
CHART_MEAN_STDDEV = "均值标准差图"
RULE_NUMBERS = {1: "一", 2: "二", 3: "三", 4: "四"}
SINGLE, MEAN, RANGE, STDDEV = "单值", "均值", "极差", "标准差"
PERIOD_JOIN = "至"

# Control chart constants by subgroup size.
A2_D4 = {
    2: (1.880, 3.267),
    3: (1.023, 2.574),
    4: (0.729, 2.282),
    5: (0.577, 2.114),
}
A3_B4_B3 = {
    6: (1.287, 1.970, 0.030),
    7: (1.182, 1.882, 0.118),
    8: (1.099, 1.815, 0.185),
    9: (1.032, 1.761, 0.239),
    10: (0.975, 1.716, 0.284),
    11: (0.927, 1.679, 0.321),
    12: (0.886, 1.646, 0.354),
    13: (0.850, 1.618, 0.382),
    14: (0.817, 1.594, 0.406),
    15: (0.789, 1.572, 0.428),
    16: (0.763, 1.552, 0.448),
    17: (0.739, 1.534, 0.466),
    18: (0.718, 1.518, 0.482),
    19: (0.698, 1.503, 0.497),
    20: (0.680, 1.490, 0.510),
    21: (0.663, 1.477, 0.523),
    22: (0.647, 1.466, 0.534),
    23: (0.633, 1.455, 0.545),
    24: (0.619, 1.445, 0.555),
    25: (0.606, 1.435, 0.565),
}
INDIVIDUAL_SPREAD = 2.660
INDIVIDUAL_RANGE_UCL = 3.267

# Test items that are charted, by operation.
CHARTED_ITEMS = {
    "DB": ["偏心X", "偏心Y", "浮高Z", "rotation W/um", "胶重", "胶厚", "翘曲", "Die shear"],
    "WB": [
        "Loop Height", "Inside loop height", "Outside Height", "Wire pull", "Stich  Pull", "Ball Size",
        "Ball  shear(lead)", "Ball  shear(pad)", "ball thinkess(Lead)", "ball thinkess(die)", "金线线距",
    ],
    "HM": [
        "浮高Z", "偏心X", "偏心Y", "cover 偏移", "cover 角度", "cover 胶宽", "cover 胶厚", "cover 推力",
        "cover 成品尺寸", "ROTATION  W/UM", "holder shear",
    ],
    "AA": [
        "ROTATION  W/UM", "holder shear", "尺寸高", "尺寸宽", "尺寸长",
        "UV后胶厚（上）", "UV后胶厚（下）", "UV后胶厚（左）", "UV后胶厚（右）",
        "UV后胶宽（上）", "UV后胶宽（下）", "UV后胶宽（左）", "UV后胶宽（右）",
    ],
    "VCM封合": [
        "浮高Z", "偏心X", "偏心Y", "胶水推力", "ROTATION  W/UM", "尺寸长", "尺寸宽", "尺寸高", "holder shear",
    ],
    "锁付": ["锁付高度", "锁付扭力"],
    "无螺牙锁附": ["无螺牙推力", "无螺牙tilt", "锁付高度", "胶重"],
    "保护膜": ["保护膜角度", "保护膜偏移"],
}

# Old workshop name -> (plant, new workshop name), inspection data.
WORKSHOPS = {
    "生产一区": ("台虹厂", "台虹COB一区"),
    "生产二区": ("台虹厂", "台虹COB二区"),
    "生产三区": ("台虹厂", "台虹COB三区"),
    "生产四区": ("古城二厂", "古二COB二区"),
    "生产五区": ("古城二厂", "古二COB二区"),
    "生产六区": ("台虹厂", "台虹COB六区"),
    "生产七区": ("台虹厂", "台虹COB七区"),
    "生产九区": ("台虹厂", "台虹测试九区"),
    "NP区": ("台虹厂", "台虹试产区"),
    "修复区": ("台虹厂", "台虹修复区"),
    "3D区": ("台虹厂", "3D区"),
    "古城COB一区": ("古城一厂", "古一COB一区"),
    "古城COB二区": ("古城一厂", "古一COB一区"),
    "古城后段一区": ("古城一厂", "古一测试一区"),
    "古城后段二区": ("古城一厂", "古一测试二区"),
    "古城试产二区": ("古城一厂", "古一试产二区"),
    "古二试产一区": ("古城二厂", "古二试产一区"),
    "古二试产二区": ("古城二厂", "古二试产二区"),
    "古二测试三区": ("古城二厂", "古二测试三区"),
    "古二COB二区": ("古城二厂", "古二COB二区"),
    "SMT": ("古城二厂", "古二SMT"),
}

# Clean-room class -> section; other spellings a class may have.
CLASS_SECTION = {"十级": "COB", "千级": "测试"}
CLASS_SPELLINGS = {"COB": ["十级", "COB"], "测试": ["千级", "测试"]}

# Workshops whose new name depends on the section, (plant, name for COB, name for 测试).
WORKSHOPS_BY_SECTION = {
    "生产一区": ("台虹厂", "台虹COB一区", "台虹测试一区"),
    "生产二区": ("台虹厂", "台虹COB二区", "台虹测试二区"),
    "生产三区": ("台虹厂", "台虹COB三区", "台虹测试三区"),
    "生产四区": ("古城二厂", "古二COB二区", "古二测试三区"),
    "生产六区": ("台虹厂", "台虹COB六区", "台虹测试六区"),
    "生产七区": ("台虹厂", "台虹COB七区", "台虹测试七区"),
}

# A workshop that only the section-wise and the final-QC map know.
WORKSHOPS_EXTRA = {"古城试产一区": ("古城一厂", "古一试产一区")}

# Plant of a workshop in the second source.
SECOND_SOURCE_PLANTS = {
    "生产一区": "台虹厂",
    "生产二区": "台虹厂",
    "生产三区": "台虹厂",
    "生产四区": "汉浦厂",
    "生产五区": "汉浦厂",
    "生产六区": "台虹厂",
    "生产七区": "台虹厂",
    "生产八区": "汉浦厂",
    "生产九区": "台虹厂",
    "NP区": "台虹厂",
    "修复区": "台虹厂",
    "3D区": "台虹厂",
    "古城COB一区": "古城厂",
    "古城后段一区": "古城厂",
    "古城后段二区": "古城厂",
    "古城后段三区": "古城厂",
    "古城试产一区": "古城厂",
    "古城试产二区": "古城厂",
}

# The workshop that moved to another plant, before and after.
MOVED_FROM = ("生产四区", "汉浦厂")
MOVED_TO = ("古二COB二区", "古城厂")

# Final-QC operations, plants left out of the limit re-check, the station of the second source.
FINAL_QC_OPERATIONS = ["QC外观检", "QC CCD检验"]
RECHECK_EXCLUDED_PLANTS = ["台虹厂", "古城一厂"]
BONDING = "WB"
