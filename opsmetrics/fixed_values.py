"""Values that decide results and are given from outside.

Every operator takes them as arguments; these are the defaults.
"""

# --- fixed values -----------------------------------------------------------

# Display order of the hosts, first to last.
HOST_ORDER = [
    "BI Server", "Talend Server 1", "Talend Server 2", "Scheduler Server",
    "Repo Server", "Datanode 1", "Datanode 2", "Datanode 3",
    "Gatewaynode", "Activenode", "Standbynode", "Backup",
]

# Report group -> unanchored, case-sensitive pattern on the host name.
GROUP_PATTERNS = {
    "BI to Repo Stats": "BI Server|Talend|Scheduler|Repo",
    "Datanode to Backup Stats": "Datanode|Gatewaynode|Activenode|Standbynode|Backup",
}

# Metric column -> name shown in the host report.
DISPLAY_NAMES = {
    "server_name": "Name",
    "datetime_record": "Date",
    "cpu_usage_percent": "useCPU(%)",
    "used_ram_gb": "usedRam(GB)",
    "total_ram_gb": "maxRam(GB)",
    "used_disk_gb": "useDisk(GB)",
    "used_disk_percent": "useDisk(%)",
}

# Metric -> [(exclusive lower bound, colour)], else the default colour.
SNAPSHOT_LEVELS = {
    "useCPU(%)": [(80, "red"), (70, "yellow")],
    "useRam(%)": [(80, "red"), (70, "yellow")],
    "useDisk(%)": [(80, "red"), (70, "yellow")],
}
DISK_LEVELS = {"useDisk(%)": [(70, "yellow")]}

# Health state -> colour of its cell; any other state is white.
STATE_PALETTE = {
    "GOOD": "#4CAF50",
    "CONCERNING": "#FF9800",
    "BAD": "#F44336",
    "N/A": "#BDBDBD",
}

# Counters of a storage report: one capture group each, commas allowed.
USED_PATTERN = r"DFS Used:\s+([\d,]+)\s+B"
REMAINING_PATTERN = r"DFS Remaining:\s+([\d,]+)\s+B"

# Text of a probe sample of a host that could not be reached.
UNREACHABLE_CPU = "Connection Failed"
UNREACHABLE_OTHER = "N/A"

# ---------------------------------------------------------------------------

# Measures of the host report that are shown with two decimals.
ROUNDED = [
    "cpu_usage_percent",
    "used_ram_gb",
    "total_ram_gb",
    "used_disk_gb",
    "used_disk_percent",
]
