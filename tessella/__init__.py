"""Customer segmentation at scale on Spark DataFrames and MLlib."""

from tessella.config import SegmentationConfig
from tessella.plans.segmentation import Segmentation, segment_customers
from tessella.session import get_session

__all__ = ["Segmentation", "SegmentationConfig", "get_session", "segment_customers"]
