"""Code lists, lookup tables and base numbers that define the results.

Nothing here is logic. The numbers must equal the published classification tables, so
they are stated plainly and in natural order.
"""

# Default extract range, and the first extract that has tax records.
FIRST_EXTRACT = 2005
LAST_EXTRACT = 2024
FIRST_TAX_EXTRACT = 2006

# Episodes are never expanded to years before this one.
FIRST_PANEL_YEAR = 1960

# Education code -> seven levels.
EDUCATION_7 = {
    "10": 10, "11": 10,
    "20": 20, "21": 20, "22": 20,
    "30": 30, "31": 30, "32": 30,
    "40": 40, "41": 40, "42": 40,
    "43": 50, "44": 50, "45": 50,
    "46": 60, "47": 60,
    "48": 70,
}

# Seven levels -> four levels.
EDUCATION_4 = {10: 1, 20: 1, 30: 2, 40: 3, 50: 4, 60: 4, 70: 4}

# Consumer price index (2013 = 100) and its 2018 base.
CPI = {
    2005: 83.694, 2006: 86.637, 2007: 89.067, 2008: 92.693, 2009: 92.413,
    2010: 93.907, 2011: 96.256, 2012: 98.614, 2013: 100.000, 2014: 99.836,
    2015: 99.348, 2016: 99.022, 2017: 101.008, 2018: 103.664, 2019: 104.390,
    2020: 104.056, 2021: 107.271, 2022: 116.268, 2023: 120.372, 2024: 123.790,
}
CPI_BASE = 103.664

# Province -> region.
PROVINCE_REGION = {
    1: 16, 2: 8, 3: 10, 4: 1, 5: 7, 6: 11, 7: 4, 8: 9, 9: 7, 10: 11,
    11: 1, 12: 10, 13: 8, 14: 1, 15: 12, 16: 8, 17: 9, 18: 1, 19: 8, 20: 16,
    21: 1, 22: 2, 23: 1, 24: 7, 25: 9, 26: 17, 27: 12, 28: 13, 29: 1, 30: 14,
    31: 15, 32: 12, 33: 3, 34: 7, 35: 5, 36: 12, 37: 7, 38: 5, 39: 6, 40: 7,
    41: 1, 42: 7, 43: 9, 44: 2, 45: 8, 46: 10, 47: 7, 48: 16, 49: 7, 50: 2,
    51: 18, 52: 19,
}

# Contribution regimes, as inclusive ranges.
WORK_REGIMES = [(111, 137), (140, 180), (611, 650), (811, 823), (840, 850), (911, 950)]
SELF_EMPLOYED_REGIMES = [(521, 540), (721, 740), (825, 831)]
DOMESTIC_REGIMES = [(138, 138), (1200, 1250)]

# Job relationship codes of registered unemployment.
UNEMPLOYED_RELATIONS = [751, 752, 753, 754, 755, 756]

# Municipality ranges outside the common tax territory.
FORAL_MUNICIPALITIES = [(1000, 1999), (20000, 20999), (31000, 31999), (48000, 48999)]

# Valid juridical status letters of a firm.
JURIDICAL_STATUS = list("ABCDEFGHJNPQRSUVW")

# Retirement pension classes, the partial ones among them, regimes left out.
RETIREMENT_CLASSES = ["20", "21", "22", "23", "24", "25", "26", "J1", "J2", "J3", "J4", "J5"]
PARTIAL_RETIREMENT_CLASSES = ["25", "J3"]
EXCLUDED_PENSION_REGIMES = [36, 37]

# Payment types of the tax withholding records.
UNEMPLOYMENT_PAYMENT = "C"
PENSION_PAYMENT = "B"
PROFESSIONAL_PAYMENTS = {"G": [0, 2], "H": [3]}  # type -> subtypes left out
NON_WORK_PAYMENTS = ["B", "C", "D", "E", "G", "H", "I", "J", "K", "L", "M"]

# Contract group -> original contract codes.
CONTRACT_GROUPS = {
    100: [1, 17, 22, 32, 33, 49, 69, 70, 71],
    109: [11, 35, 101, 109],
    130: [9, 29, 59],
    150: [8, 20, 28, 40, 41, 42, 43, 44, 45, 46, 47, 48, 50, 60, 61, 62, 80, 86, 88, 91,
          150, 151, 152, 153, 154, 155, 156, 157],
    200: [3],
    209: [38, 102, 209],
    250: [63, 81, 89, 98, 250, 251, 252, 253, 254, 255, 256, 257],
    300: [18],
    309: [185, 186, 309],
    350: [181, 182, 183, 184, 350, 351, 352, 353, 354, 355, 356, 357],
    401: [14],
    402: [15],
    410: [16, 72, 75, 82, 92],
    420: [58, 96],
    421: [85, 87, 97],
    430: [30, 31],
    441: [5],
    450: [457],
    500: [4],
    510: [73, 76, 83, 93],
    520: [6],
    540: [34],
    550: [557],
}
CONTRACT_GROUP = {code: group for group, codes in CONTRACT_GROUPS.items() for code in codes}

# Contract groups that are permanent, and those that are temporary.
PERMANENT_CONTRACTS = [23, 65, 100, 109, 130, 131, 139, 141, 150, 189, 200, 209, 230, 231, 239,
                       250, 289, 300, 309, 330, 331, 339, 350, 389]
TEMPORARY_CONTRACTS = [7, 10, 12, 13, 24, 26, 27, 36, 37, 53, 54, 55, 56, 57, 64, 66, 67, 68,
                       74, 77, 78, 79, 84, 94, 401, 402, 403, 408, 410, 418, 420, 421, 430,
                       431, 441, 450, 451, 452, 500, 501, 502, 503, 508, 510, 518, 520, 530,
                       531, 541, 550, 551, 552]
