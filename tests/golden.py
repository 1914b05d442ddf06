"""A small dirty data set with known results.

Fixed values: the two texts and the numbers below them belong together.
"""

CUSTOMERS_CSV = """\
customer_id,signup_date,country
C001,2024-01-02,NL
C002,2024-01-11,DE
C003,2024-01-27,FR
C004,2024-02-05,NL
C005,2024-02-28,SE
C006,2024-03-03,UK
C007,2024-03-15,NL
C008,2024-03-22,DE
C009,2024-04-10,FR
C010,2024-04-18,NL
C011,2024-04-25,UK
C012,2024-05-02,SE
C013,2024-05-09,DE
C014,2024-05-20,NL
C015,2024-06-01,FR
C016,2024-06-12,DK
C017,2024-06-18,NL
C018,2024-07-01,UK
C019,2024-13-05,NL
C020,2024-07-21,SE
C021,2024-08-02,FR
C022,2024-08-10,NL
C023,2024-08-19,DE
C024,2024-09-01,BE
C025,2024-09-12,NL
C026,2024-09-29,FR
C027,2024-10-03,
C028,2024-10-14,NL
C029,2024-10-21,UK
C030,2024-10-30,SE
C031,2024-11-02,NL
C032,2024-11-11,FR
C033,2024-11-25,nl
C034,2024-12-01,DE
C035,2024-12-09,NL
C036,2024-12-18,FR
C037,2024-12-21,SE
C038,2024-12-28,NL
C038,2024-12-29,DE
C039,2024-12-30,NL
"""

SUBSCRIPTIONS_CSV = """\
customer_id,start_date,end_date,plan,monthly_price
C001,2024-01-02,2024-03-31,basic,30
C001,2024-04-01,,pro,50
C002,2024-01-11,2024-02-10,basic,25
C002,2024-02-25,,basic,25
C003,2024-01-27,2024-02-28,baisc,30
C004,2024-02-05,2024-04-01,pro,55
C004,2024-03-15,2024-05-01,pro,55
C005,2024-02-28,2024-02-30,basic,20
C006,2024-03-03,2024-03-20,basic,20
C006,2024-04-01,,basic,20
C007,2024-03-15,2024-04-15,pro,60
C008,2024-03-22,,basic,30
C009,2024-04-10,,basic,25
C010,2024-04-18,2024-04-25,basic,20
C010,2024-05-01,,basic,20
C011,2024-04-25,,pro,50
C012,2024-05-02,2024-06-02,basic,30
C012,2024-06-15,,basic,30
C013,2024-05-09,,basic,25
C014,2024-05-20,2024-06-01,basic,20
C014,2024-06-05,,basic,20
C015,2024-06-01,2024-06-10,basic,15
C015,2024-06-15,,basic,15
C016,2024-06-12,,pro,60
C017,2024-06-18,2024-07-15,basic,25
C017,2024-07-01,2024-08-01,basic,25
C018,2024-07-01,,basic,20
C019,2024-07-15,,basic,30
C020,2024-07-21, ,basic,22
C021,2024-08-02,,basic,"thirty"
C022,2024-08-10,,basic,25
C023,2024-08-19,2024-09-10,basic,20
C023,2024-09-20,,basic,20
C024,2024-09-01,,pro,55
C025,2024-09-12,,basic,25
C026,2024-09-29,2024-08-20,basic,20
C027,2024-10-03,,basic,25
C028," 2024-10-14 ",,basic,30
C029,2024-10-21,2024-11-01,basic,22
C029,2024-11-05,,basic,22
C030,2024-10-30,,basic,25
C031,2024-11-02,2024-11-02,basic,10
C031,2024-11-03,,basic,10
C032,2024-11-11,,pro,50
C033,2024-11-25,,basic,25
C034,2024-12-01,,basic,20
C035,2024-12-09,,basic,22
C036,2024-12-18,,basic,30
C037,2024-12-21,,pro,55
C038,2024-12-28,,basic,25
C038,2024-12-29,,basic,25
C039,2024-12-30,,basic,20
C999,2024-10-01,,basic,15
C050,2024-09-01,,basic,25
"""

MONTHS = [f"2024-{m:02d}" for m in range(1, 13)]
MRR = [85, 185, 295, 410, 370, 480, 482, 532, 607, 689, 806, 971]
CHURN = [0, 1, 0, 1, 1, 0, 0, 1, 0, 0, 0, 0]
RETENTION = [0.6667, 0.5, 0.6667, 1, 1, 0.6667, 1, 1, 0.6667, 1, 1, 1]

WARNINGS = [
    "Customer 'C027' has missing country - keeping record",
    "Invalid end_date for subscription at row 9 - treating as active",
    "Subscription for 'C026' has end_date before start_date - skipping",
    "Unknown customer_id 'C999' at row 53 - skipping subscription",
    "Unknown customer_id 'C050' at row 54 - skipping subscription",
    "Customer 'C004' has overlapping subscriptions: 2024-02-05 to 2024-04-01 overlaps with 2024-03-15 to 2024-05-01",
    "Customer 'C017' has overlapping subscriptions: 2024-06-18 to 2024-07-15 overlaps with 2024-07-01 to 2024-08-01",
]
