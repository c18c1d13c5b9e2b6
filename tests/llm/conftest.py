import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

if not os.path.isdir("/root/testdata/sf0.001"):
    pytest.skip("test tables not there", allow_module_level=True)
