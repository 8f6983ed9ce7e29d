"""Default parameters of the analyses."""

# --- fixed values: the windows and reference date of the original queries ------------
DEFAULT_START = "20201101"
DEFAULT_END = "20210131"
DEFAULT_DAY = "20201101"
DEFAULT_AS_OF = "2021-02-01"
# --------------------------------------------------------------------------------------
