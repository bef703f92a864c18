"""Fixed values of the trace format and of the published result files.

Everything here has to be spelled exactly like this for files and messages to be
understood on the other side. Nothing in this module computes anything.
"""

# --- event codes -------------------------------------------------------------
MACHINE_ADD = 0
MACHINE_REMOVE = 1
TASK_EVICT = 2

# --- table layouts: position = order of the fields ----------------------------
# `unused_*` names a position that no analysis reads.
TABLES = {
    "machine_events": (
        "timestamp BIGINT, machine_id STRING, event_type INT, unused_3 STRING, "
        "cpu_capacity DOUBLE, memory_capacity DOUBLE"
    ),
    "job_events": (
        "timestamp BIGINT, missing_type STRING, job_id STRING, event_type INT, "
        "user STRING, scheduling_class INT, job_name STRING, logical_job_name STRING"
    ),
    "task_events": (
        "timestamp BIGINT, missing_type STRING, job_id STRING, task_index STRING, "
        "machine_id STRING, event_type INT, user STRING, scheduling_class INT, "
        "priority STRING, cpu_request DOUBLE, memory_request DOUBLE, disk_space_request DOUBLE"
    ),
    "task_usage": (
        "start_time BIGINT, unused_1 STRING, job_id STRING, task_index STRING, "
        "machine_id STRING, cpu_rate DOUBLE, memory_usage DOUBLE"
    ),
}

# --- stream messages: the time is a number, every other field is text -----------
MESSAGES = {
    "job": (
        "timestamp BIGINT, missing_type STRING, job_id STRING, event_type STRING, "
        "user STRING, scheduling_class STRING, job_name STRING, logical_job_name STRING"
    ),
    "task": (
        "timestamp BIGINT, missing_type STRING, job_id STRING, task_index STRING, "
        "machine_id STRING, event_type STRING, user STRING, scheduling_class STRING, "
        "priority STRING, cpu_request STRING, memory_request STRING, disk_space_request STRING"
    ),
}
TOPICS = {"job": "job-events", "task": "task-events"}

# --- broker options ------------------------------------------------------------
KAFKA_READ = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
}
KAFKA_WRITE = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "100",
    "kafka.batch.size": "16384",
}
TRIGGER = "10 seconds"

# --- bounds and labels of published results --------------------------------------
CAPACITY_RANGES = [(0.0, 0.2), (0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, 1.0)]
QUARTERS = [0.25, 0.5, 0.75]
PLACEMENT_LABELS = ("Same Machine", "Different Machines")
CAPACITY_LABELS = ("CPU Correlation", "Memory Correlation")
REQUEST_LABELS = ("CPU", "Memory")
PEAK_LABELS = ("CPU peaks", "Memory peaks")

# --- first part of the names of result files, by analysis --------------------------
RESULT_PREFIXES = {
    "a1": "q1",
    "a2": "q2",
    "a3": "q3",
    "a4": "q4",
    "a5": "q5_bonus1",
    "a6": "q6",
    "a7": "q7",
    "a8": "q8",
    "a9": "q9_bonus2",
    "a18": "smoke",
}

# --- gauges ----------------------------------------------------------------------
GAUGE_PREFIX = "spark_streaming_"
PROGRESS_GAUGES = ("input_rate", "processing_rate", "batch_duration", "num_input_rows")

# --- timing files -------------------------------------------------------------------
TIME_METRICS = ("reading_time", "processing_time")
SPLIT_RECORD_METRICS = "jobs_records|tasks_records"
JOB_NUMBER = r"q(\d+)"
WORKER_NUMBER = r"q5_(\d+)"
