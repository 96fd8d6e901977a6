"""The shipped alert rules as one table of typed rows.

Seven shapes cover all rules; ``operators.alerts`` evaluates a shape at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Rule:
    name: str
    shape: str  # ratio_of_rates, quantile, rate, gauge, age, gauge_ratio, average_rate
    metric: str
    op: str  # > < ==
    threshold: float
    hold: int  # seconds the condition must last
    severity: str
    team: str
    summary: str
    description: str
    window: int = 0  # seconds of the range
    every: int = 30  # seconds between evaluations
    where: dict[str, str] = field(default_factory=dict)  # label matchers
    part: dict[str, str] = field(default_factory=dict)  # numerator matchers of a ratio
    over: str = ""  # denominator metric of a gauge ratio
    q: float = 0.0
    scale: float = 1.0
    offset: float = 0.0
    pipeline: str = ""
    runbook: str = ""  # page name below the runbook address, if one is given

    def slowed(self, factor: int) -> "Rule":
        """The rule with every duration multiplied, for coarser scrapes."""
        return replace(self, window=self.window * factor, every=self.every * factor, hold=self.hold * factor)


# Names, thresholds, durations in seconds, labels and texts of the
# rules. In texts, $label is a label of the alert and $value the value, with a
# format after a bar.
AI = {"severity": "warning", "team": "ai-platform"}
ML = {"severity": "warning", "team": "ml-ops"}
DATA = {"severity": "warning", "team": "data-engineering"}
INFRA = {"severity": "warning", "team": "platform"}
CRITICAL = {"severity": "critical"}
ERRORS = {"status": "error"}

RULES: list[Rule] = [
    Rule("GenAIHighErrorRate", "ratio_of_rates", "genai_requests_total", ">", 0.05, 120, window=300, part=ERRORS, **{**AI, **CRITICAL},
         pipeline="genai", runbook="genai-high-error-rate",
         summary="GenAI error rate above 5% for $model",
         description="LLM inference error rate is $value|percentage over the last 5 minutes.\nService: $service, Model: $model\n"),
    Rule("GenAIHighLatency", "quantile", "genai_request_duration_seconds_bucket", ">", 10, 180, window=300, q=0.99, **AI, pipeline="genai",
         summary="GenAI P99 latency above 10s for $service",
         description="P99 latency is $value|duration.\nThis breaches the 10s SLO for real-time inference.\nModel: $model\n"),
    Rule("GenAIRateLimitHigh", "rate", "genai_rate_limit_hits_total", ">", 0.5, 120, window=300, **AI, pipeline="genai",
         summary="Groq API rate limits hitting frequently",
         description="Rate limit hits: $value|humanize per second over last 5 minutes.\nConsider: request batching, model fallback, or tier upgrade.\n"),
    Rule("GenAIPipelineDead", "rate", "genai_requests_total", "==", 0, 300, window=300, **{**AI, **CRITICAL}, pipeline="genai",
         summary="GenAI pipeline is processing ZERO requests",
         description="No LLM inference requests processed in the last 5 minutes.\nCheck if the service is up and Kafka consumers are running.\n"),
    Rule("GenAITokenCostSpike", "rate", "genai_tokens_total", ">", 100000, 300, window=3600, where={"type": "output"}, scale=60, **AI, pipeline="genai",
         summary="GenAI token usage unusually high — check for prompt injection or runaway loops",
         description="Output token rate: $value|humanize tokens/hour.\nThis could indicate runaway agent loops or prompt injection.\n"),
    Rule("GenAIContextWindowHigh", "gauge", "genai_context_window_utilization", ">", 0.85, 60, **AI,
         summary="LLM context window above 85% — risk of truncation",
         description="Context utilization: $value|percentage.\nLong documents or agent histories may get truncated silently.\n"),
    Rule("AgentMaxStepsReached", "rate", "agent_max_steps_reached_total", ">", 0.1, 120, window=600, **{**AI, **CRITICAL}, pipeline="agentic",
         summary="Agents hitting max steps limit — possible infinite loop",
         description="$value|humanize sessions/min are hitting the step limit.\nAgents: $agent_name. Check for circular tool dependencies.\n"),
    Rule("AgentToolFailureRate", "ratio_of_rates", "agent_tool_calls_total", ">", 0.1, 120, window=300, part=ERRORS, **AI, pipeline="agentic",
         summary="Agent tool $tool_name failing at > 10%",
         description="Tool failure rate: $value|percentage.\nTool: $tool_name, Agent: $agent_name\n"),
    Rule("AgentSessionLatencyHigh", "quantile", "agent_session_duration_seconds_bucket", ">", 120, 300, window=300, q=0.95, **AI, pipeline="agentic",
         summary="Agent sessions taking > 2 minutes at P95",
         description="P95 session duration: $value|duration.\nLong sessions exhaust LLM context and increase cost.\n"),
    Rule("AgentQueueDepthGrowing", "gauge", "agent_queue_depth", ">", 50, 180, **AI, pipeline="agentic",
         summary="Agent task queue backing up",
         description="Queue depth: $value pending tasks.\nConsider scaling up agent workers.\n"),
    Rule("AgentHallucinationSpike", "rate", "agent_hallucinations_detected_total", ">", 0.05, 300, window=600, **AI, pipeline="agentic",
         summary="Elevated hallucination detection rate in agent responses",
         description="Detected hallucinations: $value|humanize per second.\nReview recent prompts and add guardrail checks.\n"),
    Rule("MLInferenceErrorRate", "ratio_of_rates", "ml_inference_requests_total", ">", 0.01, 300, window=300, every=60, part=ERRORS, **{**ML, **CRITICAL}, pipeline="ml",
         summary="ML inference error rate above 1% for $model_name",
         description="Error rate: $value|percentage.\nModel: $model_name, Version: $model_version\n"),
    Rule("MLInferenceLatencyHigh", "quantile", "ml_inference_duration_seconds_bucket", ">", 2.0, 180, window=300, every=60, q=0.99, **ML,
         summary="ML P99 inference latency above 2s",
         description="P99: $value|duration.\nModel: $model_name. Check for feature computation bottleneck.\n"),
    Rule("MLDataDriftDetected", "gauge", "ml_data_drift_score", ">", 0.3, 600, every=60, **ML, pipeline="ml",
         summary="Data drift detected for model $model_name",
         description="Drift score: $value (threshold: 0.3).\nFeature: $feature_name.\nThe model may need retraining — review input distribution.\n"),
    Rule("MLModelAccuracyDrop", "gauge", "ml_model_accuracy", "<", 0.80, 900, every=60, **{**ML, **CRITICAL}, pipeline="ml",
         summary="Model accuracy dropped below 80%",
         description="Current accuracy: $value|percentage.\nModel: $model_name, Version: $model_version.\nTrigger retraining pipeline and consider rolling back to previous version.\n"),
    Rule("MLHighFeatureMissingRate", "gauge", "ml_feature_missing_rate", ">", 0.05, 300, every=60, **DATA,
         summary="High missing feature rate for $feature_name",
         description="Missing rate: $value|percentage.\nThis degrades model predictions. Check upstream data pipeline.\n"),
    Rule("MLLowPredictionConfidence", "quantile", "ml_prediction_confidence_bucket", "<", 0.60, 600, window=600, every=60, q=0.5, **ML,
         summary="Median prediction confidence below 60%",
         description="Median confidence: $value|percentage.\nModel is uncertain — could indicate distribution shift.\n"),
    Rule("MLTrainingPipelineStalled", "age", "ml_last_training_completed_timestamp", ">", 86400, 60, every=60, **ML,
         summary="ML training pipeline has not completed in 24h",
         description="Last training: $value|duration ago.\nCheck training job status and feature store freshness.\n"),
    Rule("KafkaConsumerLagHigh", "gauge", "kafka_consumergroup_lag", ">", 10000, 300, **{**DATA, **CRITICAL}, pipeline="kafka",
         summary="Kafka consumer group $consumergroup lagging",
         description="Consumer lag: $value|humanize messages.\nTopic: $topic, Partition: $partition.\nPipeline is falling behind real-time. Scale consumers or check for slow processing.\n"),
    Rule("KafkaConsumerGroupOffline", "gauge", "kafka_consumergroup_members", "==", 0, 120, **{**DATA, **CRITICAL},
         summary="Kafka consumer group $consumergroup has no active members",
         description="All consumers for group $consumergroup are offline."),
    Rule("KafkaTopicNoMessages", "rate", "kafka_topic_partition_current_offset", "==", 0, 300, window=300, **DATA,
         summary="No messages on Kafka topic $topic",
         description="Topic $topic has received no new messages in 5 minutes."),
    Rule("HighCPUUsage", "average_rate", "node_cpu_seconds_total", ">", 85, 300, window=300, where={"mode": "idle"}, scale=-100, offset=100, **INFRA,
         summary="CPU usage above 85% on $instance",
         description="CPU: $value|humanize%. This can slow down model inference."),
    Rule("HighMemoryUsage", "gauge_ratio", "node_memory_MemAvailable_bytes", ">", 85, 300, over="node_memory_MemTotal_bytes", scale=-100, offset=100, **INFRA,
         summary="Memory usage above 85% on $instance",
         description="Memory: $value|humanize% used. Risk of OOM kills for ML models."),
    Rule("DiskSpaceLow", "gauge_ratio", "node_filesystem_avail_bytes", "<", 15, 300, over="node_filesystem_size_bytes", where={"mountpoint": "/"}, scale=100,
         **{**INFRA, **CRITICAL},
         summary="Disk space below 15% on $instance",
         description="Available: $value|humanize%. Log accumulation from AI pipelines can fill disk fast."),
    Rule("ServiceDown", "gauge", "up", "==", 0, 60, **{**INFRA, **CRITICAL},
         summary="Service $job is DOWN",
         description="Instance $instance has been unreachable for > 1 minute."),
    Rule("ElasticsearchClusterRed", "gauge", "elasticsearch_cluster_health_status", "==", 1, 120, where={"color": "red"}, **{**INFRA, **CRITICAL},
         summary="Elasticsearch cluster is RED — log storage unavailable",
         description="Kibana dashboards and log searches will fail."),
]
# Labels a ratio of rates sums over.
RATIO_DROPS = ["status"]
# Labels an averaged rate keeps.
AVERAGE_KEEPS = ["instance"]
