"""Fixed texts and lookup tables of alerts and notification payloads.

Everything in the block below must equal the monitored system's output byte
for byte (messages are stored and shown to people).
"""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
ALERT_TYPE_QUALITY = "QUALITY_ALERT"

# Alert message per metric; {v} and {t} are value and threshold with one
# decimal.
ALERT_MESSAGES = {
    "completeness": "데이터 완전성이 {v}%로 임계값 {t}% 미만입니다.",
    "timeliness": "데이터 적시성이 {v}%로 임계값 {t}% 미만입니다.",
    "temperature_validity": "온도 데이터 유효성이 {v}%로 임계값 {t}% 미만입니다.",
    "humidity_validity": "습도 데이터 유효성이 {v}%로 임계값 {t}% 미만입니다.",
    "wind_speed_validity": "풍속 데이터 유효성이 {v}%로 임계값 {t}% 미만입니다.",
    "consistency": "데이터 일관성이 {v}%로 임계값 {t}% 미만입니다.",
}
ALERT_MESSAGE_DEFAULT = "{name} 메트릭이 임계값을 벗어났습니다: {v} (임계값: {t})"

SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")  # rank 1..4
SEVERITY_COLORS = {"LOW": "good", "MEDIUM": "warning", "HIGH": "danger", "CRITICAL": "#FF0000"}
SEVERITY_COLOR_DEFAULT = "warning"

ALERT_EMOJIS = {
    "QUALITY_ALERT": "⚠️",
    "SYSTEM_ERROR": "🔥",
    "SENSOR_OFFLINE": "📵",
    "DATA_DELAY": "⏰",
    "THRESHOLD_BREACH": "📊",
}
ALERT_EMOJI_DEFAULT = "ℹ️"

FOOTER = "Smart City Data Quality System"
QUALITY_TITLE = "🚨 데이터 품질 알림 - {sensor_id}"
QUALITY_TEXT = "센서 {sensor_id}에서 데이터 품질 문제가 감지되었습니다."
QUALITY_FIELD_VALUE = "현재값: {v}\n임계값: {t}\n상태: {status}"
QUALITY_USERNAME = "DataQualityBot"
QUALITY_ICON = ":warning:"
SYSTEM_TITLE = "{emoji} 시스템 알림 - {alert_type}"
SYSTEM_USERNAME = "SystemBot"
SYSTEM_ICON = ":robot_face:"
SUMMARY_TITLE = "📊 일일 데이터 품질 요약 보고서"
SUMMARY_FIELD_TITLES = ("총 센서 수", "처리된 데이터 건수", "품질 평가 수행 횟수", "실패한 품질 검사")
SUMMARY_TOP_TITLE = "문제 센서 Top 5"
SUMMARY_TOP_LINE = "• {sensor_id}: {fail_count}건"
SUMMARY_USERNAME = "ReportBot"
SUMMARY_ICON = ":bar_chart:"
SUMMARY_COLOR = "good"
DEFAULT_CHANNEL = "#smart-city-alerts"

# Dashboard colour bands of a percentage score: red below 80, yellow below 95.
SCORE_BANDS = (("red", 80.0), ("yellow", 95.0), ("green", None))
# ---------------------------------------------------------------------------
