"""Names, domains and table layouts shared by the operators.

Every operator takes its column names as arguments; the values here are only the defaults that make
the library fit the detection tables it was written for.
"""

from __future__ import annotations

import re

# --- fixed values: column names of the detection and track tables -------------------------------
TRACK_KEYS = ("cam_ID", "rec_ID", "track_ID")
RANKS = ("bioclip_species", "bioclip_genus", "bioclip_family", "bioclip_order", "bioclip_class")
SCORE = "bioclip_score"
CLASS = "top1"
CLASS_PROB = "top1_prob"
PROB = "top1_prob_weighted"
PLANT = "plant_species"

# --- fixed values: domains ------------------------------------------------------------------------
POLLINATOR_ORDERS = ("Hymenoptera", "Diptera", "Lepidoptera", "Coleoptera")
ORDER_SHORT = {"Hymenoptera": "hym", "Lepidoptera": "lep", "Coleoptera": "col", "Diptera": "dip"}
HOVERFLY_FAMILY = "Syrphidae"
REVIEW_LEVELS = ("genus", "family", "species", "order")
POLLINATOR_LABELS = ("pollinator", "non-pollinator", "unclear")
CORRECTNESS_LABELS = ("correct", "incorrect", "unclear")
CROP_STATES = ("valid", "dismissed")

# --- fixed values: session config files -----------------------------------------------------------
ANY_DEVICE = "[^_]+"
CONFIG_NAME = rf"^(\d{{4}}-\d{{2}}-\d{{2}}_\d{{2}}-\d{{2}}-\d{{2}})_config_{ANY_DEVICE}_(flower|platform)\.json$"
CONFIG_STAMP = "yyyy-MM-dd_HH-mm-ss"
CAMERA_PATHS = (
    "network.hotspot.ssid",
    "network.wifi.ssid",
    "device.id",
    "camera.id",
    "camera_name",
    "device_name",
    "cam_id",
    "ssid",
)
SETTING_PATHS = ("deployment.setting",)
CONFIG_NUMBERS = {
    "location_latitude": "deployment.location.latitude",
    "location_longitude": "deployment.location.longitude",
    "location_accuracy": "deployment.location.accuracy",
    "lens_position_manual": "camera.focus.lens_position.manual",
    "lens_position_min": "camera.focus.lens_position.range.min",
    "lens_position_max": "camera.focus.lens_position.range.max",
}
DETECTIONS_GLOB = "*metadata_merged_crops_classified.csv"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"

# --- fixed values: required columns of the review inputs ------------------------------------------
REVIEW_COLUMNS = (
    "crop_path",
    "bioclip_species",
    "bioclip_genus",
    "bioclip_family",
    "bioclip_order",
    "duration_s",
    "top1_prob_weighted",
    "det_conf_mean",
)
EXPERT_COLUMNS = ("crop_path", "duration_s", "top1_prob_weighted", "det_conf_mean")

SEED = 123


def config_name(device: str | None = None) -> str:
    """The pattern of config file names, of any device tag or of one."""
    return CONFIG_NAME if device is None else CONFIG_NAME.replace(ANY_DEVICE, re.escape(device))


def _ddl(pairs: str) -> str:
    return ", ".join(p.strip() for p in pairs.strip().splitlines() if p.strip())


# fixed values: columns of the detection and track tables
DETECTION_DDL = _ddl(
    """
    cam_ID string
    rec_ID string
    track_ID string
    timestamp string
    confidence double
    x_min double
    y_min double
    x_max double
    y_max double
    bioclip_species string
    bioclip_genus string
    bioclip_family string
    bioclip_order string
    bioclip_class string
    bioclip_score double
    crop_path string
    """
)

# fixed values
PLAIN_DETECTION_DDL = _ddl(
    """
    cam_ID string
    rec_ID string
    track_ID string
    timestamp string
    confidence double
    x_min double
    y_min double
    x_max double
    y_max double
    top1 string
    top1_prob double
    crop_path string
    """
)

# fixed values
TRACK_DDL = _ddl(
    """
    cam_ID string
    rec_ID string
    track_ID string
    track_ID_imgs bigint
    top1_imgs bigint
    top1 string
    top1_prob_mean double
    top1_prob_weighted double
    plant_species string
    bioclip_species string
    bioclip_genus string
    bioclip_family string
    bioclip_order string
    bioclip_class string
    start_time timestamp_ntz
    end_time timestamp_ntz
    duration_s bigint
    det_conf_mean double
    bbox_length_mean double
    bbox_width_mean double
    order_category string
    """
)
