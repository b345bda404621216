"""Fixed input and output schemas (names and types are part of the interface)."""

USER_VISIT_ACTION = (
    "date string, user_id bigint, session_id string, page_id bigint, action_time string, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, "
    "order_category_ids string, order_product_ids string, pay_category_ids string, "
    "pay_product_ids string, city_id bigint"
)
USER_INFO = (
    "user_id bigint, username string, name string, age int, professional string, "
    "city string, sex string"
)
PRODUCT_INFO = "product_id bigint, product_name string, extend_info string"
CITY_INFO = "city_id bigint, city_name string, area string"

VISIT_BUCKETS = (
    "1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m", "10m_30m", "30m",
)
STEP_BUCKETS = ("1_3", "4_6", "7_9", "10_30", "30_60", "60")

SESSION_STAT = ("taskid string, session_count bigint, "
                + ", ".join(f"visit_length_{b}_ratio double" for b in VISIT_BUCKETS) + ", "
                + ", ".join(f"step_length_{b}_ratio double" for b in STEP_BUCKETS))
SESSION_SAMPLE = ("taskid string, sessionid string, startTime string, searchKeywords string, "
                  "clickCategoryIds string")
SESSION_DETAIL = ("taskid string, userid bigint, sessionid string, pageid bigint, "
                  "actionTime string, searchKeyword string, clickCategoryId bigint, "
                  "clickProductId bigint, orderCategoryIds string, orderProductIds string, "
                  "payCategoryIds string, payProductIds string")
TOP_CATEGORY = ("taskid string, categoryid bigint, clickCount bigint, orderCount bigint, "
                "payCount bigint")
TOP_SESSION = "taskid string, categoryid bigint, sessionid string, clickCount bigint"
PAGE_CONVERSION = "taskid string, convertRate string"
AREA_TOP = ("taskid string, area string, areaLevel string, productid bigint, "
            "cityInfos string, clickCount bigint, productName string, productStatus string")

AD_CLICK = "ts_ms bigint, date string, province string, city string, userid bigint, adid bigint"
AD_BLACKLIST = "userid bigint"
AD_USER_DAY = "date string, userid bigint, adid bigint, click_count bigint"
AD_STAT = "date string, province string, city string, adid bigint, click_count bigint"
AD_PROVINCE_TOP = "date string, province string, adid bigint, click_count bigint"
AD_TREND = "date string, hour string, minute string, adid bigint, click_count bigint"
AD_REJECT = "value string, reason string"
