import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from streamcharts.session import local_session

    ckpt = tempfile.mkdtemp(prefix="streamcharts-test-ckpt-")
    s = local_session(4, shuffle_partitions=8, app_name="streamcharts-tests", checkpoint_dir=ckpt)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="streamcharts-test-")


# The library takes the pseudonym's key from its caller; the tests use the registered queries' one.
def pseudonym(user, salt=None):
    from streamcharts.functions import privacy
    from streamcharts.plans.params import SALT

    return privacy.pseudonym(user, salt or SALT)


def decode_messages(messages, salt=None):
    from streamcharts.operators import events
    from streamcharts.plans.params import SALT

    return events.decode_messages(messages, salt or SALT)


def start_rollups(*args, **kwargs):
    from streamcharts.plans.params import SALT
    from streamcharts.streaming import processor

    return processor.start_rollups(*args, **{"salt": SALT, **kwargs})
