"""Business constants. All are defaults of mart parameters and can be replaced."""

from __future__ import annotations

import datetime as dt

# ---------------------------------------------------------------------------
# These must equal the production values for results to match.
# ---------------------------------------------------------------------------

# event names of entry and exit
EVENT_IN = "club_in"
EVENT_OUT = "club_out"

# campaign purchases
STAFF_PLAN_IDS = (1, 152, 208)
CAMPAIGN_PLAN_IDS = (205, 206, 208)
CAMPAIGN_PROVIDERS = (1, 2, 6, 9, 10, 17, 20)
CAMPAIGN_START = dt.date(2024, 5, 27)
TRIAL_PLAN_ID = 207
BANNER_EVENT = "%banner%"
BANNER_PARAMETERS = '%"banner\\_id":78%'
KEPT_MAIN_DISCOUNTS = (
    "СТУДЕНЧЕСКИЙ 1000р",
    "ТрейдИн 1000р",
    "Трейд-ин 0 руб",
    "День рождения",
)
CLIENT, EMPLOYEE = "Клиент", "Сотрудник"
BANNER_YES, BANNER_NO = "Перешел по баннеру", "Не переходил"
TRIAL_YES, TRIAL_NO = "Был триал", "Не было триала"
TRACKER_YES = "Пришел по трекеру"
TRACKER_DAYS = 30
MIN_VIDEO_SECONDS = 60

# transactions that start a subscription
FIRST_PAYMENT_PROVIDERS = (6, 17, 20, 21, 26, 27)

# video sessions
SESSION_GAP_SECONDS = 10_800
MIN_SESSION_ROWS = 3
SECONDS_PER_ROW = 17
SECONDS_BASE = 30
OPEN_END = dt.date(2049, 1, 1)

# accounting labels
OPERATION_NAMES = {
    0: "0",
    1: "Рекуррентная оплата подписки",
    2: "Оплата подписки",
    3: "Пополнение баланса",
    5: "Покупка с баланса",
    6: "Регистрация подписки",
    7: "Покупка продукта",
    8: "Возврат подписки",
    9: "Смена подписки",
    11: "Возврат покупки",
    12: "Покупка заморозки с депозита",
    13: "Покупка заморозки с карты",
    14: "Возврат покупки заморозки с депозита",
    15: "Возврат покупки заморозки с карты",
    16: "Смена платежной карты",
    17: "Регистрация подписки с баланса",
    18: "Возврат покупки с депозита",
    19: "Возврат подписки с депозита",
}
TAX_NAMES = {0: "0", 1: "ставка НДС 20%", 6: "НДС не облагается"}
COUNTED_FISCAL_STATUSES = ("Commit", "Awaiting success transact", "Waiting commit")
LEDGER_SHIFT_HOURS = 6

# subscription sales
BARTER_PATTERN, TRIAL_PATTERN = "%бартер%", "%trial%"
RANKED_TYPES = ("barter", "main", "trial")
LEGACY_ID_BELOW = 1_000_000
RETURN_DAYS = 365
NEW_CLIENT = "НЧК"
RETURNED_SOON = "БЧК < 1 года"
RETURNED_LATE = "БЧК > 1 года"
CAMPAIGN_RULES = (
    ("%Getblogger 04.2024%", "Getblogger 04.2024"),
    ("%Getblogger 05.2024%", "Getblogger 05.2024"),
    ("%Getblogger 06.2024%", "Getblogger 06.2024"),
    ("%Getblogger 07.2024%", "Getblogger 07.2024"),
    ("%Getblogger 08.2024%", "Getblogger 08.2024"),
    ("%Getblogger 09.2024%", "Getblogger 09.2024"),
    ("%Getblogger 10.2024%", "Getblogger 10.2024"),
    ("%Getblogger 11.2024%", "Getblogger 11.2024"),
    ("%Getblogger 12.2024%", "Getblogger 12.2024"),
    ("%GB именные 09.2024%", "GB именные 09.2024"),
    ("%Perfluence 06.2024%", "Perfluence 06.2024"),
    ("%Perfluence 10.2024%", "Perfluence 10.2024"),
    ("%Perfluence 11.2024%", "Perfluence 11.2024"),
    ("%Perfluence 12.2024%", "Perfluence 12.2024"),
    ("%PF именные 12.2024%", "PF именные 12.2024"),
    ("%MEGABD%", "MEGABD 12.2024"),
)

# debt cohorts
DEBT_PLAN_IDS = (18, 20, 22, 92, 103, 118, 135, 162, 241, 242, 243)
DEBT_FROM = dt.datetime(2023, 12, 1)
DEBT_TRIAL_DISCOUNT = 11538
DEBT_DAYS = 11
AUTO_CANCEL = "AutoCanceledByDebt"
EXCLUDED_REASON = "ExcludeFromReport"

# visits
VISIT_MINUTES = 90
OCCUPANCY_BUFFER_HOURS = 2

# class attendance
NO_ATTENDANCE_PLAN_IDS = (1, 111, 152, 161)
LIVE_STATUSES = ("Current", "Freezed", "NotStarted", "PaymentPending")
ATTENDANCE_FROM = dt.date(2023, 1, 1)

# flows
OPEN_PLAN_EXCLUDED = ("Ended", "Created", "Deleted", "Refunded")
CLOSED_PLAN_STATUSES = ("Ended", "Refunded")
LOAD_FACTOR_FROM = dt.date(2018, 3, 1)
LIFE_GAP_DAYS = 90
LAST_GAP = 999

# revenue
REVENUE_EXCLUDED_PLANS = (111, 1)
REVENUE_PLUS = (1, 2, 5, 6, 7, 9, 10, 12, 13, 16, 17, 20, 21, 24, 25, 26, 27, 28, 29, 30, 31, 34, 37, 38)
REVENUE_MINUS = (8, 11, 14, 15, 18, 19)

# anomalies
MOVING_ROWS = 180
INFLOW_OVER_MEAN = 1.8
INFLOW_OVER_PREVIOUS = 2.5
OUTFLOW_IQR = 1.5
OUTFLOW_OVER_PREVIOUS = 2

# mobile
STORY_EVENTS = (
    "stories_get_error",
    "stories_views_error",
    "stories_preview_load_error",
    "stories_slide_background_load_error",
    "stories_answers_error",
    "stories_open_route_error",
    "stories_open",
    "stories_closed",
    "stories_hold",
)
TRACKERS = (
    "action_from_main_banner_aos",
    "action_from_action__aos",
    "action_new_from_action__aos",
    "action_new_from_main_banner_aos",
)
TRACKER_DEVICE_PATTERN = "tracker_device_id=(.*?)&"

# club tiers and age bands
TIER_1 = (5, 9, 14, 15, 19, 25, 26, 31, 34, 40, 42, 47, 50)
TIER_2 = (
    2, 3, 4, 7, 8, 11, 13, 17, 21, 24, 27, 28, 30, 33, 35, 36, 37, 38, 39, 41, 44, 46,
    48, 49, 51, 52, 53, 54, 55, 56, 57, 58, 59, 60, 61, 62, 63,
)
AGE_YOUNG, AGE_JUNIOR, AGE_MATURE = "молодые", "юниоры", "зрелые"

# trainer pay
METRO_CITY = "Москва"
METRO_SATELLITES = (
    "Москва", "Красногорск", "Мытищи", "Одинцово", "Химки",
    "Зеленоград", "Домодедово", "Люберцы", "Балашиха",
)
STRENGTH_CATEGORY = 40
INTENSIVE_PATTERNS = ("%HIIT%", "%GRIT%", "%CYCLE SPRINT@")
YOGA_PATTERNS = ("%YOGA%", "%ЙОГА%", "%Йога%", "%Yoga%")
SPRINT_PATTERNS = ("%CYCLE SPRINT@",)
CYCLE_PATTERNS = ("%Cycle%",)
STAR_CYCLE_TRAINER = "Звездный тренер сайкл"
UNPAID_CATEGORIES = (
    "Smart Start", "Игра «Элиас»", "Игра «Мафия»",
    "Семинар «Женское здоровье и фитнес»", "Соревнования «Железные люди»", "30 min Fullbody",
)
PAY_FROM = dt.datetime(2024, 1, 1)
