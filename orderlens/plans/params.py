"""Fixed parameters of the catalogue queries on the driver's test tables.

The driver's order dates run 1995-01-01..2001-08-01, so the training window is a
22-month span inside them and the scoring window is the following quarter (the studied
workflow trained on 2020-09-01..2022-06-30 and scored 2022-07-01..2022-09-30).
"""

W_START, W_END = "1996-09-01", "1998-06-30"
SCORE_START, SCORE_END = "1998-07-01", "1998-09-30"
DECIMALS = 6
