"""termscope: course enrolment analytics as PySpark DataFrame operators."""
